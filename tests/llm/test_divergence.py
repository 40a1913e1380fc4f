"""The divergence audit against SQL, with and without digests that terms share."""

from __future__ import annotations

import random

import duckdb
import pytest

from logtrail.llm import divergence, sql_checks
from logtrail.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, gid string, n int"


def made_rows() -> list[tuple]:
    rng = random.Random(3)
    words = ["Alpha", "beta", "été", "日本", "x" * 5000, "ÀB", "àb", "zeta", "eta", "theta", "a\x00b", "don't", "q1w2"]
    rows = [(None, None, None, None, "c", 1), (1, "", "en", None, "c", 1), (2, "solo", "xx", "s1", None, 1), (3, "solo two", "xx", "s2", None, 2)]
    for i in range(120):
        text = " ".join(rng.choices(words, range(1, len(words) + 1), k=rng.randint(0, 30)))
        rows.append((i // 2, text, rng.choice(["en", "de", ""]), rng.choice(["s1", "s2", "s3", "ß", None]), "c", i))
    return rows + rows[20:60]


def expected(folder: str) -> list[tuple]:
    duckdb.sql(f"create or replace temp view documents as select * from read_parquet('{folder}/documents.parquet/*.parquet')")
    return sorted(duckdb.sql(sql_checks.DIVERGENCE).fetchall())


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("audit"))
    spark.createDataFrame(made_rows(), SCHEMA).repartition(5).write.parquet(f"{folder}/documents.parquet")
    return folder


def test_query_matches_sql_on_odd_rows(spark, made):
    got = QUERIES["op12_source_divergence"].run(spark, made)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == expected(made)


@pytest.mark.parametrize("bits", [1, 3])
def test_terms_that_share_a_digest_are_told_apart(spark, made, bits):
    got = divergence.audit(spark.read.parquet(f"{made}/documents.parquet"), bits=bits)
    assert sorted(map(tuple, got.collect())) == expected(made)


def test_ranks_end_at_top_with_ties_by_text(spark):
    rows = [(i, f"common t{'abcdefghij'[i % 10]} t{'abcdefghij'[i % 10]}", "en", f"s{i % 2}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    got = divergence.audit(docs, top=3).where("part = 'term'").collect()
    assert {(r["source"], r["rank"], r["item"]) for r in got} == {("s0", 1, "ta"), ("s0", 2, "tc"), ("s0", 3, "te"), ("s1", 1, "tb"), ("s1", 2, "td"), ("s1", 3, "tf")}


def test_empty_table(spark):
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).collect() == []
