"""Folder operations through Hadoop, for any file system Spark can reach."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from itertools import islice

from pyspark.sql import SparkSession

THREADS = 16
WINDOW = 1_000


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists."""
    fs, jpath = _fs(spark, path)
    return fs.exists(jpath)


def is_file(spark: SparkSession, path: str) -> bool:
    """Whether a path names one file."""
    fs, jpath = _fs(spark, path)
    return fs.exists(jpath) and fs.getFileStatus(jpath).isFile()


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder, empty when there is no such folder."""
    fs, jpath = _fs(spark, path)
    if not fs.exists(jpath):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(jpath))


def written_at(spark: SparkSession, path: str) -> dict[str, int]:
    """Names directly under a folder with the time of their last change, in milliseconds."""
    fs, jpath = _fs(spark, path)
    if not fs.exists(jpath):
        return {}
    return {status.getPath().getName(): status.getModificationTime() for status in fs.listStatus(jpath)}


def existing(spark: SparkSession, paths: list[str]) -> list[str]:
    """Those of some paths that are there, looked up side by side."""
    with ThreadPoolExecutor(THREADS) as pool:
        return [path for path, there in zip(paths, pool.map(lambda path: exists(spark, path), paths), strict=True) if there]


def delete(spark: SparkSession, path: str) -> bool:
    """Remove a folder; False when it was not there."""
    fs, jpath = _fs(spark, path)
    return fs.delete(jpath, True)


def delete_all(spark: SparkSession, paths: list[str]) -> int:
    """Remove many folders side by side; the number that were there."""
    with ThreadPoolExecutor(THREADS) as pool:
        return sum(pool.map(lambda path: delete(spark, path), paths))


def is_mounted(spark: SparkSession, path: str) -> bool:
    """Whether a path is one that workers open like their own files."""
    fs, _ = _fs(spark, path)
    return fs.getUri().getScheme() == "file"


def _below(spark: SparkSession, path: str, root: str | None) -> str:
    """A path relative to a root; the whole path where it is not below it."""
    plain = spark._jvm.org.apache.hadoop.fs.Path(path).toUri().getPath()
    if root:
        top = spark._jvm.org.apache.hadoop.fs.Path(root).toUri().getPath().rstrip("/") + "/"
        if plain.startswith(top):
            return plain[len(top) :]
        if plain == top.rstrip("/"):
            return plain.rsplit("/", 1)[-1]
    return plain.lstrip("/")


def move_into(spark: SparkSession, path: str, folder: str, root: str | None = None) -> str | None:
    """Move a file into a folder, at its place below ``root``; None when it is gone already.

    A file that is there is never replaced: the new one gets a number.
    """
    fs, jpath = _fs(spark, path)
    name = _below(spark, path, root)
    for number in range(1, 1_000_000):
        target = spark._jvm.org.apache.hadoop.fs.Path(folder, name if number == 1 else f"{name}.{number}")
        if not fs.exists(jpath):
            return None
        if fs.exists(target):
            continue
        fs.mkdirs(target.getParent())
        if fs.rename(jpath, target):
            return str(target)
        if fs.exists(jpath) and not fs.exists(target):
            break
    raise OSError(f"could not move {path} to {folder}")


def move_all(spark: SparkSession, paths: Iterable[str], folder: str, root: str | None = None) -> None:
    """Move files into a folder, many side by side; the list is taken a window at a time."""
    waiting: Iterator[str] = iter(paths)
    with ThreadPoolExecutor(THREADS) as pool:
        while window := list(islice(waiting, WINDOW)):
            list(pool.map(lambda path: move_into(spark, path, folder, root), window))
