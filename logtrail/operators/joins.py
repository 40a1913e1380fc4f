"""Joins of facts with one-row-per-key tables: J1–J4."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(facts: DataFrame, lookup: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join facts with a table that has at most one row per key.

    There is no hint on purpose. Catalyst broadcasts the lookup while its
    measured size is under the broadcast limit and shuffles beyond it. In a
    shuffled join the adaptive skew handling, which ``session.configure``
    forces on, splits the fact side of a key that holds much of the data, for
    every join type used here.
    """
    return facts.join(lookup, keys, how)


def attach_log(facts: DataFrame, logs: DataFrame, key: str = "log_hash") -> DataFrame:
    """Each fact with the row of its log."""
    return lookup_join(facts, logs, [key], "inner")


def one_position_per_key(location: DataFrame, keys: list[str], latest_by: list[str]) -> DataFrame:
    """Latest position per key, so that attaching it never repeats a fact."""
    values = [c for c in location.columns if c not in keys]
    order = [c for c in latest_by if c in values] + [c for c in values if c not in latest_by]
    best = F.max(F.struct(*order)).alias("_best")
    return location.groupBy(*keys).agg(best).select(*keys, *[F.col("_best")[c].alias(c) for c in values])


def attach_position(
    facts: DataFrame, location: DataFrame, keys: list[str], latest_by: list[str] | None = None
) -> DataFrame:
    """Each fact with its position, null where there is none.

    Give ``latest_by`` unless the key is known to be unique.
    """
    if latest_by is not None:
        location = one_position_per_key(location, keys, latest_by)
    return lookup_join(facts, location, keys, "left")


def already_merged(incoming: DataFrame, ledger: DataFrame, key: str = "log_hash") -> DataFrame:
    """Incoming rows whose log is in the ledger."""
    return lookup_join(incoming, ledger.select(key), [key], "left_semi")


def new_logs(incoming: DataFrame, ledger: DataFrame, key: str = "log_hash") -> DataFrame:
    """Incoming rows whose log is not in the ledger."""
    return lookup_join(incoming, ledger.select(key), [key], "left_anti")


def missing_columns(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Catalog rows the source has and the target lacks."""
    return source.join(target.select(*keys).distinct(), keys, "left_anti")


def schema_difference(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Columns that only one side has, both ways."""
    to_add = missing_columns(source, target, keys).select(*keys).distinct()
    to_pad = missing_columns(target, source, keys).select(*keys).distinct()
    return to_add.withColumn("side", F.lit("source_only")).unionByName(
        to_pad.withColumn("side", F.lit("target_only"))
    )


def first_files(files: DataFrame, key: str = "log_hash", order: str = "path") -> DataFrame:
    """The first file of each log, by a pre-aggregated minimum (M2)."""
    return files.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(order).alias(order))


def first_file_wins(files: DataFrame, key: str = "log_hash", order: str = "path") -> DataFrame:
    """Files with ``is_first``: true for the first one of each log (M2).

    Files are marked by a join on their own unique name, so many copies of one
    log never meet in one task. Files without a log are not marked.
    """
    first = first_files(files, key, order).select(order, F.lit(True).alias("is_first"))
    marked = files.join(first, order, "left")
    return marked.withColumn("is_first", F.coalesce("is_first", F.lit(False)))
