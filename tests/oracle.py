"""Compare a Spark result with the SQL that should give the same rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        db.execute(f"create view {file.stem} as select * from '{file}'")
    return db


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return bytes(value) if isinstance(value, bytearray) else value


def compare(spark_df, db, sql: str) -> str | None:
    """None when equal, else what differs."""
    result = db.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} and {sorted(names)}"
    want = rows_of(names, result.fetchall())
    got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if len(want) != len(got):
        return f"{len(got)} rows, not {len(want)}"
    for g, w in zip(got, want, strict=True):
        if g != w or [type(a) for a in g] != [type(a) for a in w]:
            return f"{g} and not {w}"
    return None
