"""Analytic views over merged tables: V1–V4, G3, J2."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtrail import fixed_values as fixed
from logtrail.functions import cleaning
from logtrail.operators import aggregates, joins
from logtrail.plans.store import LogStore


def with_position(
    facts: DataFrame, location: DataFrame | None = None, position_key: str = "posid", log_key: str = "log_hash"
) -> DataFrame:
    """Facts with ``lat`` and ``lon``: their own, or those of the position table."""
    if {"lat", "lon"} <= set(facts.columns) or location is None:
        return facts
    position = location.select(log_key, position_key, "time", "lat", "lon").withColumnRenamed("time", "_at")
    return joins.attach_position(facts, position, [log_key, position_key], ["_at"]).drop("_at")


def kpi_with_position(facts: DataFrame, kpi: str, location: DataFrame | None = None) -> DataFrame:
    """One KPI on the map: rows that have a value, with time and position (V1)."""
    placed = with_position(facts.where(F.col(kpi).isNotNull()), location)
    return placed.select("log_hash", "time", "lat", "lon", F.col(kpi).alias("kpi"))


def kpi_bundle(
    facts: DataFrame, kpis: list[str], location: DataFrame | None = None, ordered: bool = True
) -> DataFrame:
    """Several KPIs with time and position, in time order (V2)."""
    placed = with_position(facts, location).select("log_hash", "time", *kpis, "lat", "lon")
    return placed.orderBy("time", "log_hash") if ordered else placed


def l3_messages(signalling: DataFrame) -> DataFrame:
    """Layer-3 messages with their direction; ``info`` keeps its lines (V3)."""
    rows = signalling
    if "direction" not in rows.columns:
        rows = rows.withColumn("direction", cleaning.direction(F.col("symbol")))
    return rows.select("log_hash", "time", "symbol", "direction", "info")


def log_inventory(logs: DataFrame, active: DataFrame) -> DataFrame:
    """Logs that are merged now (V4)."""
    return joins.already_merged(logs, active)


def latest_imei(log_info: DataFrame) -> DataFrame:
    """IMEI per log (G1)."""
    return aggregates.latest_nonempty(log_info, "IMEI", ["seqid"])


def log_sizes(store: LogStore) -> DataFrame:
    """Stored bytes per merged log; null once it is unmerged."""
    return store.ledger().select("log_hash", "status").join(store.log_sizes(), "log_hash", "left")


def slowest_operations(store: LogStore) -> DataFrame:
    """The operations that took longest."""
    return aggregates.slowest_operations(store.metrics())


def inventory_of(store: LogStore) -> DataFrame:
    """The log inventory of a store (V4)."""
    return log_inventory(store.table(fixed.LOGS_TABLE), store.active_logs())
