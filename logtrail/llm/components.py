"""Connected components of a graph given as pairs of numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtrail.session import scratch_path


def stored(rows: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read back: lineage ends there."""
    place = scratch_path(rows.sparkSession, label)
    rows.write.parquet(place)
    return rows.sparkSession.read.parquet(place)


def fresh_name(rows: DataFrame, name: str) -> str:
    """A column name like ``name`` that the rows do not have."""
    while name in rows.columns:
        name = f"_{name}"
    return name


def components(pairs: DataFrame) -> DataFrame:
    """``node, component`` (the smallest number reachable) of every number in the two columns of ``pairs``.

    Large-star and small-star steps in turn until nothing changes. Minima are
    combined before they are shuffled, and written before they are joined, so
    that the join of a node with very many neighbours can be split.
    """
    first, second = pairs.columns
    edges = pairs.select(F.greatest(first, second).alias("a"), F.least(first, second).alias("b")).where("a <> b").distinct()
    edges = stored(edges, "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stored(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m")), "least")
        large = stored(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct(), "edges")
        least = stored(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        edges = stored(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if now == before:
            break
        before = now
    roots = edges.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("component"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
