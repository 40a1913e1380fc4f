"""Declared types to Spark types, and widening between logs: P12, P13."""

from __future__ import annotations

from functools import reduce

from logtrail import fixed_values as fixed

# Declared type (lower case, without length) to Spark type.
DECLARED_TYPES = {
    "double": "double",
    "float": "double",
    "real": "double",
    "smallint": "bigint",
    "int": "bigint",
    "integer": "bigint",
    "bigint": "bigint",
    "bigint unique": "bigint",
    "biginteger": "bigint",
    "short": "smallint",
    "text": "string",
    "string": "string",
    "varchar": "string",
    "test": "string",
    "datetime": "string",
    "timestamp": "string",
    "blob": "binary",
    "geometry": "binary",
}

# Types where text that does not parse is an error and not just a null.
CHECKED_TYPES = ("smallint", "int", "bigint", "double", "decimal(20,0)")

# From narrow to wide; a type can be widened to any one after it.
WIDENING_ORDER = ("smallint", "int", "bigint", "double", "string")


def quoted(name: str) -> str:
    """A column name for use in an expression, whatever signs it has."""
    return "`" + name.replace("`", "``") + "`"


def unused(names: list[str], like: str) -> str:
    """A name like ``like`` that is none of ``names``, case aside."""
    taken = {name.lower() for name in names}
    while like.lower() in taken:
        like = f"_{like}"
    return like


def is_datetime_column(column: str) -> bool:
    """Whether a column holds times, by its name."""
    return column.endswith("time") and not column.endswith(fixed.NOT_DATETIME_SUFFIXES)


def spark_type(declared: str, column: str, table: str) -> str:
    """Spark type of a source column: name rules first, then the declared type."""
    if is_datetime_column(column):
        return "timestamp_ntz"
    if column.endswith("duration") or column in fixed.FLOAT_RATE_COLUMNS.get(table, ()):
        return "double"
    if column.endswith("session_master_session_id"):
        return "string"
    if column == fixed.UNSIGNED_64_COLUMN:
        return "decimal(20,0)"
    if column in fixed.UNSIGNED_32_COLUMNS or column == "log_hash":
        return "bigint"
    plain = declared.strip().lower()
    if plain in DECLARED_TYPES:
        return DECLARED_TYPES[plain]
    return DECLARED_TYPES.get(plain.split("(")[0].strip(), "string")


def widen(left: str, right: str) -> str:
    """Smallest type that holds both; text when nothing else does."""
    if left == right:
        return left
    if {left, right} == {"bigint", "double"}:
        # Neither holds all of the other: numbers beyond 2**53, and fractions.
        return "string"
    if left in WIDENING_ORDER and right in WIDENING_ORDER:
        return max(left, right, key=WIDENING_ORDER.index)
    return "string"


def widest(types: list[str]) -> str:
    """Smallest type that holds all."""
    return reduce(widen, types)
