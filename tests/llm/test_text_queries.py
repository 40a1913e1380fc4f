"""The registered text queries on the small tables, against SQL or plain twins; the pipeline."""

from __future__ import annotations

import hashlib
import zlib

import duckdb
import oracle
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from logtrail.llm import toxicity
from logtrail.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(n for n, q in QUERIES.items() if q.sql))
def test_query_matches_sql(spark, name):
    assert oracle.compare(entry.queries()[name](spark, FOLDER), oracle.connect(FOLDER), entry.oracle_sql()[name]) is None


@pytest.mark.parametrize(("name", "label", "divisor", "remainder"), [("op5_quality_votes", "quality", 5, 0), ("op10_toxicity", "toxic", 3, 1)])
def test_classifiers_on_held_out_rows(spark, name, label, divisor, remainder):
    rows = {r["doc_id"]: r for r in entry.queries()[name](spark, LARGER).collect()}
    known = duckdb.sql(f"select doc_id, {label} from '{LARGER}/labels.parquet'").fetchall()
    held = [(rows[i], y) for i, y in known if zlib.crc32(str(i).encode()) % divisor == remainder]
    assert all(r["held_out"] for r, _ in held)
    assert len(rows) == duckdb.sql(f"select count(*) from '{LARGER}/documents.parquet'").fetchall()[0][0]
    assert sum(r["predicted"] == y for r, y in held) >= 0.95 * len(held)


def test_pipeline_stages_take_effect(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == columns
    last = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert 0 < last.count() <= before
    assert "text" not in last.columns and "token_ids" in last.columns
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for row in last.collect():
        assert row["decoded_sha256"] == hashlib.sha256((texts[row["doc_id"]] or "").encode()).hexdigest()
        assert row["n_tokens"] == len(row["token_ids"])


def test_pipeline_drops_toxic_documents(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    kept = {r["doc_id"] for r in corpus_pipeline.without_toxic(spark, docs, LARGER).select("doc_id").collect()}
    known = duckdb.sql(f"select doc_id, toxic from '{LARGER}/labels.parquet'").fetchall()
    assert sum((i in kept) == (y == 0) for i, y in known) >= 0.97 * len(known)
    assert corpus_pipeline.without_toxic(spark, docs.limit(0), LARGER).count() == 0
    assert toxicity.THRESHOLD > 0
