"""Union of differing schemas: M3, M4."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtrail.functions.types import quoted, widen


def merge_by_name(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of both, columns by name, null where a side lacks one (M3, M4).

    A column with two types takes the smallest type that holds both.
    """
    left_types, right_types = dict(left.dtypes), dict(right.dtypes)
    target = {c: widen(t, right_types[c]) for c, t in left_types.items() if c in right_types}
    return _cast(left, target).unionByName(_cast(right, target), allowMissingColumns=True)


def _cast(df: DataFrame, target: dict[str, str]) -> DataFrame:
    types = dict(df.dtypes)
    changed = {c: F.col(quoted(c)).cast(t) for c, t in target.items() if types[c] != t}
    return df.withColumns(changed) if changed else df


def conform(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Exactly the given columns and types, null where absent (M4)."""
    present = set(df.columns)
    return df.select(
        *[(F.col(quoted(c)) if c in present else F.lit(None)).cast(t).alias(c) for c, t in columns.items()]
    )
