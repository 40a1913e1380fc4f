"""Point geometry as column expressions: X1–X3.

A point blob is sliced and its two doubles are rebuilt from their bits with
built-in functions, so no row leaves the JVM. Anything that is not a point of
the expected layout keeps its bytes and has no coordinates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtrail import fixed_values as fixed


def _hex_at(blob: Column, offset: int, length: int) -> Column:
    return F.hex(F.substring(blob, offset + 1, length))


def is_point(blob: Column) -> Column:
    """Whether a blob has the point layout."""
    return (
        (F.length(blob) == fixed.POINT_BLOB_LENGTH)
        & (_hex_at(blob, 0, 6) == fixed.POINT_BLOB_HEADER)
        & (_hex_at(blob, fixed.POINT_CLASS_AT, 4) == fixed.POINT_CLASS)
    )


def is_ewkb_point(wkb: Column) -> Column:
    """Whether bytes are an EWKB point as made by :func:`to_ewkb`."""
    return (F.length(wkb) == fixed.EWKB_POINT_LENGTH) & (_hex_at(wkb, 0, 9) == fixed.EWKB_POINT_PREFIX)


def _with_prefix(prefix: str, blob: Column) -> Column:
    head = F.unhex(F.lit(prefix))
    return F.concat(head, F.substring(blob, fixed.POINT_X_AT + 1, 16))


def to_ewkb(blob: Column) -> Column:
    """Point blob to EWKB, other blobs unchanged."""
    return F.when(is_point(blob), _with_prefix(fixed.EWKB_POINT_PREFIX, blob)).otherwise(blob)


def to_mssql(blob: Column) -> Column:
    """Point blob to the SQL Server geometry layout, other blobs unchanged."""
    return F.when(is_point(blob), _with_prefix(fixed.MSSQL_POINT_PREFIX, blob)).otherwise(blob)


def ewkb_to_mssql(wkb: Column) -> Column:
    """EWKB point to the SQL Server layout, for rows already converted."""
    head = F.unhex(F.lit(fixed.MSSQL_POINT_PREFIX))
    return F.when(is_ewkb_point(wkb), F.concat(head, F.substring(wkb, 10, 16))).otherwise(wkb)


def _bits(text: str, offset: int) -> str:
    """SQL: eight little-endian bytes in hex text as a signed 64-bit number."""
    pairs = ", ".join(f"substring({text}, {2 * (offset + 7 - i) + 1}, 2)" for i in range(8))
    return f"cast(conv(concat({pairs}), 16, -10) as bigint)"


def _double(bits: str) -> str:
    """SQL: the IEEE-754 double with the given bits; every step is exact."""
    exponent = f"(shiftrightunsigned({bits}, 52) & 2047L)"
    fraction = f"(cast({bits} & 4503599627370495L as double) / 4503599627370496D)"
    sign = f"if({bits} < 0, -1D, 1D)"
    return f"""case when {exponent} = 2047 and {fraction} > 0 then double('NaN')
                    when {exponent} = 2047 then {sign} * double('Infinity')
                    when {exponent} = 0 then {sign} * {fraction} * power(2D, -1022D)
                    else {sign} * ({fraction} + 1D) * power(2D, cast({exponent} - 1023 as double)) end"""


def with_doubles(df: DataFrame, blob: Column, first: int, names: list[str]) -> DataFrame:
    """Add little-endian doubles that follow each other from a zero-based byte offset.

    The steps are separate columns, so each one is computed once per row.
    """
    text = F.hex(F.substring(blob, first + 1, 8 * len(names)))
    bits = {f"_bits_{n}": F.expr(_bits("_hex", 8 * i)) for i, n in enumerate(names)}
    doubles = {n: F.expr(f"case when _bits_{n} is not null then {_double(f'_bits_{n}')} end") for n in names}
    return df.withColumn("_hex", text).withColumns(bits).withColumns(doubles).drop("_hex", *bits)


def with_coordinates(df: DataFrame, blob: str, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Add X and Y of a point blob column, null for anything else."""
    point = F.when(is_point(F.col(blob)), F.col(blob))
    return with_doubles(df, point, fixed.POINT_X_AT, [lon, lat])
