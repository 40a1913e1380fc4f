"""Aggregations: G1–G7. All combine partially before their shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtrail.operators.joins import lookup_join

SLOWEST_SHOWN = 20


def latest_nonempty(rows: DataFrame, value: str, order: list[str], key: str = "log_hash") -> DataFrame:
    """Per log, the last value that is not empty (G1)."""
    kept = rows.where(F.col(value) != "")
    return kept.groupBy(key).agg(F.max_by(value, F.struct(*order)).alias(value))


def add_to_rows(rows: DataFrame, per_log: DataFrame, key: str = "log_hash") -> DataFrame:
    """Per-log values put on every row of the log, null where there are none (G1)."""
    return lookup_join(rows, per_log, [key], "left")


def fallback_end_time(logs: DataFrame, heartbeat: DataFrame, key: str = "log_hash", time: str = "time") -> DataFrame:
    """Logs with an empty end time get their last heartbeat."""
    last = heartbeat.groupBy(key).agg(F.max(time).alias("_last"))
    end = F.coalesce("log_end_time", "_last").alias("log_end_time")
    others = [c for c in logs.columns if c != "log_end_time"]
    return logs.join(last, key, "left").select(*others, end)


def total_size(parts: DataFrame, size: Column, key: str = "log_hash") -> DataFrame:
    """Bytes per log from one row per stored object."""
    return parts.groupBy(key).agg(F.sum(size).alias("size_bytes"))


def slowest_operations(metrics: DataFrame, shown: int = SLOWEST_SHOWN) -> DataFrame:
    """The operations that took longest, ties in name order."""
    ties = [c for c in ("table", "operation", "batch_id") if c in metrics.columns]
    return metrics.orderBy(F.desc("duration"), *ties).limit(shown)


def run_summary(dispositions: DataFrame) -> DataFrame:
    """Files per outcome."""
    return dispositions.groupBy("status").agg(F.count(F.lit(1)).alias("files"))


def schema_fingerprints(ddl: DataFrame, key: str = "log_hash", text: str = "ddl") -> DataFrame:
    """SHA-1 over the sorted schema statements of each log.

    Statements are made distinct first, so what is gathered per log is its
    schema and never its rows.
    """
    statements = ddl.select(key, text).distinct().groupBy(key).agg(F.collect_list(text).alias("_all"))
    joined = F.concat_ws("\n", F.sort_array("_all"))
    return statements.select(key, F.sha1(joined.cast("binary")).alias("fingerprint"))


def schema_drift(fingerprints: DataFrame) -> DataFrame:
    """Logs per fingerprint."""
    return fingerprints.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("logs"))


def first_row(rows: DataFrame, key: str = "path", order: str = "row_no") -> DataFrame:
    """First row per key, by ``order``."""
    values = [c for c in rows.columns if c != key]
    best = F.min_by(F.struct(*values), F.col(order)).alias("_first")
    return rows.groupBy(key).agg(best).select(key, *[F.col("_first")[c].alias(c) for c in values])
