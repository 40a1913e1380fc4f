"""Table, row and column filters: F1–F11."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtrail import fixed_values as fixed
from logtrail.operators.joins import lookup_join


def parse_table_list(text: str | None) -> tuple[str, ...]:
    """Table names from a list separated by commas or line ends."""
    return tuple(name.strip() for name in re.split(r"[,\n]", text or "") if name.strip())


@dataclass(frozen=True)
class TableFilter:
    """Which tables take part.

    ``only`` replaces the excluded list altogether and always keeps ``logs``.
    """

    only: tuple[str, ...] = ()
    exclude: tuple[str, ...] = ()
    relational_target: bool = False

    def _allowed(self) -> tuple[str, ...]:
        return (*self.only, fixed.LOGS_TABLE)

    def _excluded(self) -> tuple[str, ...]:
        return (*fixed.DEFAULT_EXCLUDED_TABLES, *self.exclude)

    def keeps(self, table: str) -> bool:
        """The filter for one name, used while a file is open."""
        if table == fixed.NEVER_IMPORTED_TABLE or fixed.NEVER_IMPORTED_INFIX in table:
            return False
        if table.startswith(fixed.NEVER_IMPORTED_PREFIX):
            return False
        if self.relational_target and table == fixed.COLUMNAR_ONLY_TABLE:
            return False
        return table in self._allowed() if self.only else table not in self._excluded()

    def condition(self, table: Column) -> Column:
        """The same filter as a predicate over a catalog column."""
        kept = (
            (table != fixed.NEVER_IMPORTED_TABLE)
            & ~table.contains(fixed.NEVER_IMPORTED_INFIX)
            & ~table.startswith(fixed.NEVER_IMPORTED_PREFIX)
        )
        if self.relational_target:
            kept = kept & (table != fixed.COLUMNAR_ONLY_TABLE)
        if self.only:
            return kept & table.isin(*self._allowed())
        return kept & ~table.isin(*self._excluded())


def version_gate(table: Column, version: Column) -> Column:
    """False for rows of a table the app version got wrong."""
    return ~((table == fixed.VERSION_GATED_TABLE) & (version < fixed.VERSION_GATE))


def log_bounds(start: Column, end: Column, hours: int = fixed.CLAMP_MARGIN_HOURS) -> tuple[Column, Column]:
    """Earliest and latest time of a log's rows; both are whole seconds and inclusive."""
    zero = F.lit(0)
    span = F.make_dt_interval(zero, F.lit(hours), zero, zero.cast("decimal(18,6)"))
    low, high = (F.date_trunc("SECOND", c).cast("timestamp_ntz") for c in (start, end))
    return low - span, high + span


def clamp_to_log(
    facts: DataFrame,
    logs: DataFrame,
    *,
    time: str = "time",
    key: str = "log_hash",
    start: str = "log_start_time",
    end: str = "log_end_time",
    hours: int = fixed.CLAMP_MARGIN_HOURS,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Facts whose time fits their log (F7, J5); rows without a log or a time go.

    ``carry`` names columns of the log to keep, so one join serves both needs.
    """
    low, high = log_bounds(F.col(start), F.col(end), hours)
    bounds = logs.select(key, low.alias("_low"), high.alias("_high"), *carry)
    joined = lookup_join(facts.where(F.col(time).isNotNull()), bounds, [key], "inner")
    return joined.where(F.col(time).between(F.col("_low"), F.col("_high"))).drop("_low", "_high")


def only_location_geometry(df: DataFrame, table: str) -> DataFrame:
    """Geometry stays in the position table only."""
    return df if table == fixed.LOCATION_TABLE else df.drop(fixed.GEOMETRY_COLUMN)


def drop_legacy(df: DataFrame) -> DataFrame:
    """The legacy millisecond column goes."""
    return df.drop(fixed.LEGACY_COLUMN)


def of_log(df: DataFrame, *log_hashes: int) -> DataFrame:
    """Rows of the given logs; prunes partitions on merged tables."""
    return df.where(F.col("log_hash").isin(*log_hashes))
