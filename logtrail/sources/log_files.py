"""Log files as rows: S1, S2, S4, S5, S7.

``decode`` opens each file once in a Python task and gives one flat row shape
for all tables; everything after it is column expressions. A row is

* a table row: ``cells`` holds the bytes of each cell by position, texts as
  UTF-8, blobs as they are, numbers as text. ``layout`` names the columns and
  declared types of the row's table in its file. ``time_text`` repeats the time
  so that it can be filtered on without reading the rest, and ``doubt`` tells
  whether a cell of a number column was stored as anything but a plain number;
* ``#column``: one column of one table of one file, with its layout;
* ``#summary``: rows read from one table, how many are in doubt, which columns
  hold blobs or texts against their type, and the error that cut it short;
* ``#file``: one per file, with the error that made it unreadable;
* ``#schema``: one per statement of its schema, where only names are read.

Rows other than those of tables have a ``note``, a map of names to texts; rows
of ``NAMED_TABLES`` have one of their cells, too. Column names that the rules
know are given in small letters, as SQLite does not tell cases apart.

``chunk`` numbers runs of ``CHUNK_ROWS`` rows of one table of one file. It
bounds how many rows share a key of (file, chunk).
"""

from __future__ import annotations

import hashlib
import io
import json
import re
import shutil
import sqlite3
import tempfile
import zipfile
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from contextlib import closing
from itertools import chain, islice
from pathlib import Path
from urllib.parse import quote, unquote, urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logtrail import fixed_values as fixed
from logtrail import files
from logtrail.functions import cleaning
from logtrail.functions.types import CHECKED_TYPES, spark_type
from logtrail.operators.filters import TableFilter

CHUNK_ROWS = 250_000
# A batch of rows ends at either; a row is fetched only when the ones before it leave room.
BATCH_ROWS, BATCH_BYTES = 5_000, 16 << 20
# Where tasks cannot open a path themselves, a file comes as one value, which has this limit.
VALUE_LIMIT = 2_000_000_000

COLUMN_ROWS = "#column"
SUMMARY_ROWS = "#summary"
FILE_ROWS = "#file"
SCHEMA_ROWS = "#schema"

# Tables whose rows also come by column name.
NAMED_TABLES = (fixed.LOGS_TABLE, fixed.LOG_INFO_TABLE)

DECODED_SCHEMA = (
    "path string, chunk int, row_no bigint, has_time boolean, time_text string, doubt boolean, layout string, "
    "cells array<binary>, note map<string,string>, table_name string"
)
ARROW_SCHEMA = pa.schema(
    [
        ("path", pa.string()),
        ("chunk", pa.int32()),
        ("row_no", pa.int64()),
        ("has_time", pa.bool_()),
        ("time_text", pa.string()),
        ("doubt", pa.bool_()),
        ("layout", pa.string()),
        ("cells", pa.list_(pa.binary())),
        ("note", pa.map_(pa.string(), pa.string())),
        ("table_name", pa.string()),
    ]
)

# Storage classes of SQLite, as numbers.
NONE, INTEGER, REAL, TEXT, BLOB = range(5)
_CLASSES = {type(None): NONE, int: INTEGER, float: REAL, str: TEXT, bytes: BLOB}
# Texts in number columns that are beyond doubt; an empty one counts as no value.
_PLAIN = {"bigint": re.compile(r"-?[0-9]{1,18}|"), "double": re.compile(r"-?[0-9]{1,300}(\.[0-9]{1,300})?|")}
_LENIENT = re.compile(r"\s*[+-]?[0-9]{0,17}(?![0-9]).*", re.DOTALL)


def _listed(spark: SparkSession, path: str) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if not files.is_file(spark, path):
        reader = reader.option("pathGlobFilter", fixed.LOG_FILE_GLOB)
    return reader.load(path)


def read_log_files(spark: SparkSession, path: str) -> DataFrame:
    """A log file, or all log files under a folder, as ``(path, content)``.

    Paths that workers mount come without content: a task opens the file
    itself, of whatever size. From other stores the content comes along; a
    file larger than one value comes without it, and a merge reports it.
    """
    return with_content(_listed(spark, path), files.is_mounted(spark, path))


def with_content(listed: DataFrame, mounted: bool) -> DataFrame:
    """``(path, content)`` of listed files."""
    none = F.lit(None).cast("binary").alias("content")
    if mounted:
        return listed.select("path", none)
    small = listed.where(f"length <= {VALUE_LIMIT}").select("path", "content")
    return small.unionByName(listed.where(f"length > {VALUE_LIMIT}").select("path", none))


def schema_statements(log_files: DataFrame) -> DataFrame:
    """``(path, ddl)``: every statement of each file's schema, for fingerprints.

    Tables, views, indexes and triggers, with constraints, whatever is filtered on import.
    """
    rows = decode(log_files, TableFilter(), names_only=True).where(F.col("table_name") == SCHEMA_ROWS)
    return rows.select("path", cell("sql").alias("ddl"))


def cell(name: str, note: str = "note") -> Column:
    """An entry of the note of decoded rows."""
    return F.try_element_at(F.col(note), F.lit(name))


def canonical(column: str) -> str:
    """The name of a column: in small letters where the rules know it."""
    return column.lower() if column.lower() in fixed.KNOWN_COLUMNS else column


def layout_of(columns: list[tuple[str, str]]) -> str:
    """A short name for (column, declared type) in order, the same in all files."""
    return hashlib.blake2b(json.dumps(columns).encode(), digest_size=12).hexdigest()


def decode(
    log_files: DataFrame,
    tables: TableFilter | None = None,
    location_geometry_only: bool = False,
    also: tuple[str, ...] = (),
    names_only: bool = False,
) -> DataFrame:
    """All rows of all kept tables of ``log_files(path, content)``.

    ``also`` names tables that are read whatever the filter says. With
    ``names_only`` the columns of the tables come, and no rows.
    """
    tables = tables or TableFilter()

    def keeps(name: str) -> bool:
        return name in also or tables.keeps(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1), strict=True):
                yield from _file_batches(path.as_py(), content.as_py(), keeps, location_geometry_only, names_only)

    return log_files.select("path", "content").mapInArrow(run, DECODED_SCHEMA)


def _file_batches(
    path: str, content: bytes | None, keeps: Callable[[str], bool], location_only: bool, names_only: bool = False
) -> Iterator[pa.RecordBatch]:
    error = None
    try:
        source = _local_file(path) if content is None else io.BytesIO(content)
        folder = tempfile.TemporaryDirectory(prefix="log-")
    except OSError as failure:
        yield _notes(path, FILE_ROWS, [{"error": _named(failure)}])
        return
    # The database is unpacked to this task's own disk and read from there: its size is no matter of memory.
    with folder, closing(source):
        db = None
        try:
            unpacked = Path(folder.name, "log.db")
            with zipfile.ZipFile(source) as archive, archive.open(fixed.LOG_DB_MEMBER) as member, unpacked.open("wb") as target:
                shutil.copyfileobj(member, target, 1 << 20)
            db = sqlite3.connect(f"file:{quote(str(unpacked))}?mode=ro&immutable=1", uri=True)
            names = [r[0] for r in db.execute("select name from sqlite_master where type = 'table' order by rowid")]
        except (zipfile.BadZipFile, KeyError, sqlite3.Error, NotImplementedError, RuntimeError, OSError, zlib.error) as failure:
            error, names = _named(failure), []
        yield _notes(path, FILE_ROWS, [{"error": error}])
        if names_only and names:
            statements = db.execute("select sql from sqlite_master where sql is not null order by type, name")
            yield _notes(path, SCHEMA_ROWS, [{"sql": r[0]} for r in statements])
        for name in names:
            if keeps(name) and not name.startswith("sqlite_"):
                yield from _table_batches(db, path, name, location_only, names_only)
        if db is not None:
            db.close()


def _local_file(path: str):
    """A mounted file, opened."""
    url = urlparse(path)
    if url.scheme not in ("", "file"):
        raise OSError(f"larger than {VALUE_LIMIT} bytes, and not on a path that workers can open")
    return open(unquote(url.path) if url.scheme else path, "rb")


def _table_batches(
    db: sqlite3.Connection, path: str, table: str, location_only: bool, names_only: bool
) -> Iterator[pa.RecordBatch]:
    done, error, doubtful = 0, None, 0
    odd: Counter[str] = Counter()
    try:
        declared = [(r[1], r[2]) for r in db.execute(f"pragma table_info({_quoted(table)})")]
        drop_geometry = location_only and table != fixed.LOCATION_TABLE
        found = [(name, canonical(name), kind) for name, kind in declared]
        found = [c for c in found if c[1] != fixed.LEGACY_COLUMN and not (drop_geometry and c[1] == fixed.GEOMETRY_COLUMN)]
        columns = [(name, kind) for _, name, kind in found]
        layout = layout_of(columns)
        described = [
            {"table": table, "ordinal": str(i), "column": name, "declared": kind, "layout": layout}
            for i, (name, kind) in enumerate(columns)
        ]
        yield _notes(path, COLUMN_ROWS, described)
        if names_only:
            return
        names = [name for name, _ in columns]
        time_at = names.index("time") if "time" in names else None
        checks = _Checks(table, columns)
        for rows in _row_batches(db, f"select {', '.join(_quoted(c[0]) for c in found)} from {_quoted(table)}"):
            flat = list(chain.from_iterable(rows))
            classes = np.frombuffer(bytes(map(_CLASSES.__getitem__, map(type, flat))), np.uint8).reshape(len(rows), len(columns))
            doubt = checks.doubt(rows, classes)
            checks.count_odd(classes, odd)
            doubtful += int(doubt.sum())
            times = None if time_at is None else [_time_text(row[time_at]) for row in rows]
            named = [list(zip(map(str.lower, names), row, strict=True)) for row in rows] if table in NAMED_TABLES else None
            yield _batch(path, table, done, len(rows), times, named, doubt, layout, flat)
            done += len(rows)
    except sqlite3.Error as failure:
        error = _named(failure)
    strange = ", ".join(f"{n} {what}" for what, n in sorted(odd.items())) or None
    yield _notes(path, SUMMARY_ROWS, [{"table": table, "rows": str(done), "error": error, "doubt": str(doubtful), "odd": strange}])


class _Checks:
    """What the storage classes of a table's columns should be."""

    def __init__(self, table: str, columns: list[tuple[str, str]]):
        self._names = [name for name, _ in columns]
        self._types = [spark_type(kind, name, table) for name, kind in columns]
        self._patterns = [_PLAIN.get(t) for t in self._types]
        for i, (name, kind) in enumerate(columns):
            rule = cleaning.rule_for(table, name, kind)
            if rule is not None and rule.name in ("cell_file_id", "lenient_int"):
                self._patterns[i] = _LENIENT

    def doubt(self, rows: list[tuple], classes: np.ndarray) -> np.ndarray:
        """Rows with a cell of a number column that is no plain number: a cast may lose it."""
        out = np.zeros(len(rows), bool)
        for i, kind in enumerate(self._types):
            if kind not in CHECKED_TYPES or self._names[i] == "log_hash":
                continue
            of_column, pattern = classes[:, i], self._patterns[i]
            if pattern is None:
                out |= of_column != NONE
                continue
            out |= (of_column == BLOB) | ((of_column == REAL) & (kind != "double"))
            for row in np.flatnonzero(of_column == TEXT):
                if not pattern.fullmatch(rows[row][i]):
                    out[row] = True
        return out

    def count_odd(self, classes: np.ndarray, odd: Counter[str]) -> None:
        """Count texts in blob columns and blobs in all others."""
        for i, kind in enumerate(self._types):
            wrong = int((classes[:, i] == (TEXT if kind == "binary" else BLOB)).sum())
            if wrong:
                odd[f"{'texts' if kind == 'binary' else 'blobs'} in {self._names[i]}"] += wrong


def _row_batches(db: sqlite3.Connection, sql: str) -> Iterator[list[tuple]]:
    """Rows in batches. After an error the rest is read again with a forgiving decoder, up to the bad place."""
    done = 0
    for decoder in (str, lambda raw: raw.decode("utf-8", "replace")):
        db.text_factory = decoder
        rows, size, error = [], 0, None
        try:
            for row in islice(db.execute(sql), done, None):
                rows.append(row)
                size += sum(len(value) for value in row if type(value) in (str, bytes))
                if len(rows) == BATCH_ROWS or size >= BATCH_BYTES:
                    yield rows
                    done += len(rows)
                    rows, size = [], 0
        except sqlite3.Error as failure:
            error = failure
        if error is None or decoder is not str:
            if rows:
                yield rows
            if error is not None:
                raise error
            return


def _text(value: object) -> str:
    """An entry of a note as text, blobs as hex."""
    return value if type(value) is str else value.hex().upper() if type(value) is bytes else repr(value)


def _time_text(value: object) -> str | None:
    return value if value is None or type(value) is str else str(value)


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _named(failure: Exception) -> str:
    return f"{type(failure).__name__}: {failure}"


def _notes(path: str, kind: str, entries: list[dict[str, str | None]]) -> pa.RecordBatch:
    return _batch(path, kind, 0, len(entries), None, [list(e.items()) for e in entries])


def _batch(
    path: str,
    table: str,
    first: int,
    count: int,
    times: list[str | None] | None,
    notes: list[list[tuple]] | None,
    doubt: np.ndarray | None = None,
    layout: str | None = None,
    flat: list | None = None,
) -> pa.RecordBatch:
    numbers = np.arange(first, first + count)
    if flat is None:
        cells = pa.nulls(count, pa.list_(pa.binary()))
    else:
        # Texts are taken as their UTF-8 bytes.
        values = pa.array([v if type(v) in (str, bytes, type(None)) else repr(v) for v in flat], pa.binary())
        cells = pa.ListArray.from_arrays(pa.array(np.linspace(0, len(flat), count + 1).astype(np.int32)), values)
    if notes is not None:
        notes = [[(name, _text(value)) for name, value in row if value is not None] for row in notes]
    map_type = pa.map_(pa.string(), pa.string())
    arrays = [
        pa.repeat(pa.scalar(path, pa.string()), count),
        pa.array((numbers // CHUNK_ROWS).astype(np.int32)),
        pa.array(numbers),
        pa.repeat(pa.scalar(times is not None), count),
        pa.nulls(count, pa.string()) if times is None else pa.array(times, pa.string()),
        pa.nulls(count, pa.bool_()) if doubt is None else pa.array(doubt),
        pa.repeat(pa.scalar(layout, pa.string()), count),
        cells,
        pa.nulls(count, map_type) if notes is None else pa.array(notes, map_type),
        pa.repeat(pa.scalar(table, pa.string()), count),
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=ARROW_SCHEMA)
