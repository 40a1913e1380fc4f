"""Runs of words against a direct search, and the query against its contract."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import duckdb
import pytest

from logtrail.llm import periodic_runs
from logtrail.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def direct_runs(words: list, exponent: int = 4, least: int = 6) -> list[tuple[int, int, int]]:
    found = []
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            stretch = words[i : j + q]
            if j > i and len(stretch) >= max(least, exponent * q):
                if not any(stretch[p:] == stretch[:-p] for p in range(1, q)):
                    found.append((i, len(stretch), q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def direct_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def direct_collapse(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def made_texts() -> list[str | None]:
    rng = random.Random(5)
    texts: list[str | None] = [None, "", " \t ", "a", "a a a a a", "a a a a a a", "x y " * 4 + "x", "é é é é é é é", "end\x1cend " * 9]
    for _ in range(150):
        words: list[str] = []
        while len(words) < rng.randint(1, 90):
            block = [rng.choice("abc") for _ in range(rng.randint(1, 11))]
            words += block * rng.randint(1, 6) + block[: rng.randint(0, len(block))]
        texts.append(rng.choice([" ", "\n", "  "]).join(words))
    return texts


def test_runs_and_collapsed_texts_match_a_direct_search(spark):
    texts = made_texts()
    rows = [(i % 140, t, "kept", i) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, runs string, `a.b` bigint").repartition(3)
    got = {r["a.b"]: r for r in periodic_runs.collapse(docs).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        words = direct_words(text)
        runs = direct_runs(words)
        assert [tuple(r) for r in got[i]["runs"]] == runs, text
        assert got[i]["collapsed"] == direct_collapse(words, runs)


def test_other_bounds_and_bad_ones(spark):
    docs = spark.createDataFrame([(1, "a b a b a b c c c")], "doc_id bigint, text string")
    assert [tuple(r) for r in periodic_runs.collapse(docs, exponent=3, least=3).first()["runs"]] == [(0, 6, 2), (6, 3, 1)]
    with pytest.raises(ValueError):
        periodic_runs.collapse(docs, exponent=2)
    with pytest.raises(ValueError):
        periodic_runs.collapse(docs, text="runs")


def test_empty_table_and_long_texts(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert periodic_runs.collapse(none).count() == 0
    long = " ".join(str(i) for i in range(400_000))
    docs = spark.createDataFrame([(1, long), (2, "ha " * 1_000_000), (3, "x" * 3_000_000)], "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in periodic_runs.collapse(docs).collect()}
    assert got[1]["runs"] == [] and got[1]["collapsed"] == long
    assert [tuple(r) for r in got[2]["runs"]] == [(0, 1_000_000, 1)] and got[2]["collapsed"] == "ha"
    assert got[3]["collapsed"] == "x" * 3_000_000


def test_query_matches_its_contract(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(made_texts())] + [(None, "a " * 9), (None, None), (30, "x y z " * 30), (30, "x y z " * 30)]
    rows += [(r[0], r[1]) for r in duckdb.sql(f"select doc_id + 1000, text from '{SMALL}/documents.parquet'").fetchall()]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, QUERIES["op13_periodic_runs"].run(spark, str(tmp_path)).collect()), key=repr)
    want = []
    for doc_id, text in rows:
        words = direct_words(text)
        if doc_id is not None and words:
            h = zlib.crc32(str(doc_id).encode())
            g, n = h // 10, len(words)
            if h % 10 == 0:
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = direct_runs(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        exponent = 1000 * best[1] // best[2] if runs else None
        want.append((doc_id, len(runs), *best, exponent, digest(listed), digest(direct_collapse(words, runs))))
    assert got == sorted(want, key=repr)
