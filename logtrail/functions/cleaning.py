"""Cell cleaning as column expressions: P1–P11.

Every function takes the text of a cell and gives a column. Casts never raise:
unreadable text becomes null, or the lenient value where the rule says so.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from logtrail import fixed_values as fixed

LONG_MIN = -(2**63)
LONG_MAX = 2**63 - 1
FITTING_INTEGER = r"^\s*[+-]?0*[0-9]{1,18}(?![0-9])"
INTEGER_PREFIX = r"^\s*([+-]?[0-9]+)"
NUMBER_PREFIX = r"^\s*([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)"


def to_time(text: Column) -> Column:
    """Text to timestamp, null when it is not one.

    Years have four digits. Other texts are left out before the cast, as a
    failing cast is slow.
    """
    plain = F.trim(text)
    return F.when(F.substring(plain, 5, 1) == "-", plain).try_cast("timestamp_ntz")


def to_time_ms(text: Column) -> Column:
    """Like :func:`to_time`, cut to milliseconds."""
    return F.date_trunc("MILLISECOND", to_time(text)).cast("timestamp_ntz")


def first_characters(text: Column, count: int = fixed.BSIC_CHARACTERS) -> Column:
    """The first ``count`` characters."""
    return F.substring(text, 1, count)


def lenient_integer(text: Column) -> Column:
    """Leading integer of a text, 0 without one, null only for null.

    Numbers beyond 64 bits stop at the limits. A failing cast costs far more
    than a pattern, so the common case casts only what is known to fit.
    """
    fitting = F.nullif(F.regexp_extract(text, FITTING_INTEGER, 0), F.lit("")).try_cast("bigint")
    limits = [F.lit(limit).cast("decimal(38,0)") for limit in (LONG_MIN, LONG_MAX)]
    wide = F.regexp_extract(text, INTEGER_PREFIX, 1).try_cast("decimal(38,0)")
    rest = (
        F.when(~text.rlike(INTEGER_PREFIX), F.lit(0).cast("bigint"))
        .when(wide.isNotNull(), F.least(F.greatest(wide, limits[0]), limits[1]).cast("bigint"))
        .when(text.rlike(r"^\s*-"), F.lit(LONG_MIN))
        .when(text.isNotNull(), F.lit(LONG_MAX))
    )
    return F.coalesce(fitting, rest)


def lenient_double(text: Column) -> Column:
    """Leading number of a text, 0 without one, null only for null."""
    number = F.nullif(F.regexp_extract(text, NUMBER_PREFIX, 1), F.lit("")).try_cast("double")
    return F.coalesce(number, F.when(text.isNotNull(), F.lit(0.0)))


def empty_to_null(text: Column) -> Column:
    """Empty text is no value."""
    return F.nullif(text, F.lit(""))


def direction(symbol: Column) -> Column:
    """1 for uplink messages, 0 for everything else and for null."""
    return F.when(symbol == fixed.UPLINK_SYMBOL, 1).otherwise(0)


def strip_prefix(text: Column, count: int = fixed.BAND_PREFIX_CHARACTERS) -> Column:
    """Text without its first ``count`` characters."""
    return F.substring(text, count + 1, 2147483647)


def not_a_time_to_null(text: Column) -> Column:
    """Drop the textual missing-time mark of a time column (P10)."""
    return F.nullif(text, F.lit("NaT"))


def blob_or_null(blob: Column) -> Column:
    """Binary value, null when empty."""
    return F.when(F.length(blob) > 0, blob)


@dataclass(frozen=True)
class CellRule:
    """One cleaning rule: where it applies and what it makes of the text."""

    name: str
    applies: Callable[[str, str, str], bool]
    build: Callable[[Column], Column]


# First rule that applies wins; arguments are (table, column, declared type).
CELL_RULES: tuple[CellRule, ...] = (
    CellRule("modem_time", lambda t, c, d: c == "modem_time", lambda x: to_time_ms(empty_to_null(x))),
    CellRule("bsic", lambda t, c, d: c == "gsm_bsic", first_characters),
    CellRule("cell_file_id", lambda t, c, d: c == "android_cellid_from_cellfile", lenient_integer),
    CellRule("empty_duration", lambda t, c, d: c.endswith("duration") or c.endswith("time"), empty_to_null),
    CellRule(
        "lenient_int",
        lambda t, c, d: t == fixed.LENIENT_CAST_TABLE and "int" in d.lower(),
        lenient_integer,
    ),
    CellRule(
        "lenient_double",
        lambda t, c, d: t == fixed.LENIENT_CAST_TABLE and "double" in d.lower(),
        lenient_double,
    ),
)
BAND_RULE = CellRule("band_prefix", lambda t, c, d: c == "gsm_band", strip_prefix)


def rule_for(table: str, column: str, declared: str, strip_band: bool = False) -> CellRule | None:
    """The rule for one column, if any."""
    rules = (BAND_RULE, *CELL_RULES) if strip_band else CELL_RULES
    return next((rule for rule in rules if rule.applies(table, column, declared)), None)
