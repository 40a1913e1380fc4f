"""Token shards: ids against the library on whole texts, the hash, and lookups by key."""

from __future__ import annotations

import sys
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from logtrail.llm import token_shards
from logtrail.llm.queries import QUERIES, word_bpe_file

SMALL = "/root/testdata/sf0.001"
LIBRARY = Tokenizer.from_file(word_bpe_file())
ENCODER = token_shards.WordEncoder(word_bpe_file())


def whole_ids(text: str) -> list[int]:
    return LIBRARY.encode(text, add_special_tokens=False).ids


def by_words(text: str) -> list[int]:
    return np.frombuffer(ENCODER.encode(text), ENCODER.dtype).tolist()


@given(st.text(max_size=80))
@settings(max_examples=400, deadline=None)
def test_words_give_the_ids_of_whole_texts(text):
    assert by_words(text) == whole_ids(text)


def test_every_white_space_and_special_text():
    spaces = [c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace()]
    for c in spaces:
        for text in (f"Ab{c}cd", f"'s{c}́x", f"{c}<|endoftext|>{c}é", f"1{c}{c}2"):
            assert by_words(text) == whole_ids(text), repr(c)


def test_forgotten_words_are_encoded_again(monkeypatch):
    monkeypatch.setattr(token_shards, "WORDS", 5)
    monkeypatch.setattr(token_shards, "STEP", 7)
    encoder = token_shards.WordEncoder(word_bpe_file())
    text = " ".join(f"w{i % 11}x{i % 3}" for i in range(100))
    assert np.frombuffer(encoder.encode(text), encoder.dtype).tolist() == whole_ids(text)


@pytest.mark.parametrize("n", [0, 1, 2, 63, 1000, 50_000])
def test_hash_is_minimal_and_perfect(n):
    keys = np.unique(np.random.default_rng(n).integers(-(2**63), 2**63 - 1, n))
    words, sizes = token_shards.build_hash(keys)
    before = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)))[:-1]
    assert sorted(token_shards.slots(keys, words, before, sizes)) == list(range(len(keys)))
    others = np.setdiff1d(np.random.default_rng(n + 1).integers(-(2**63), 2**63 - 1, 5000), keys)
    slot = token_shards.slots(others, words, before, sizes)
    assert ((slot >= -1) & (slot < max(len(keys), 1))).all()
    prints = np.zeros(len(keys), "<u4")
    prints[token_shards.slots(keys, words, before, sizes)] = token_shards.fingerprints(keys)
    assert (prints[slot[slot >= 0]] == token_shards.fingerprints(others[slot >= 0])).sum() <= 1


def made_rows() -> list[tuple]:
    rows = [(7, "seven"), (-3, None), (None, "no key"), (None, None), (7, "seven"), (7, "other seven"), (2**62, ""), (11, "word " * 300_000), (12, "x" * 200_000)]
    return rows + [(i * 5, f"text {i}, {'é' * (i % 4)} <|endoftext|>") for i in range(20, 400)]


def expected(rows: list[tuple]) -> tuple[dict, set[int]]:
    """Ids by key, and where documents begin in order of their keys."""
    ids = [(k, (*whole_ids(t or ""), 1)) for k, t in rows]
    by_key: dict = {}
    for k, i in ids:
        by_key.setdefault(k, []).append(i)
    return by_key, sum(len(i) for _, i in ids)


@pytest.mark.parametrize("keys_per_bucket", [500_000, 50, 7])
def test_written_ids_are_found_by_key(spark, tmp_path, monkeypatch, keys_per_bucket):
    rows = made_rows()
    docs = spark.createDataFrame([(k, t, "x", i) for i, (k, t) in enumerate(rows)], "doc_id bigint, text string, file string, start int").repartition(4)
    monkeypatch.setattr(token_shards, "BUCKET_KEYS", keys_per_bucket)
    place = f"file://{tmp_path}/shards"
    token_shards.write(docs, place, word_bpe_file())
    by_key, total = expected(rows)
    asked = spark.createDataFrame([(k,) for k, _ in rows] + [(1,), (2,), (None,)], "k bigint")
    got = token_shards.read(spark, place, asked, unkeyed=True).orderBy("start").collect()
    assert len(got) == len(rows)
    place_of, found = 0, {}
    for r in got:
        assert r["start"] == place_of
        ids = tuple(np.frombuffer(r["ids"], "<u4").tolist())
        place_of += len(ids)
        found.setdefault(r["doc_id"], []).append(ids)
    assert place_of == total
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in by_key.items()}
    keys = [r["doc_id"] for r in got]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    some = spark.createDataFrame([(7,), (1,), (11,)], "k bigint")
    again = token_shards.read(spark, place, some).collect()
    assert sorted(r["doc_id"] for r in again) == [7, 7, 7, 11]


def test_shards_close_at_their_bounds(tmp_path, monkeypatch):
    monkeypatch.setattr(token_shards, "SHARD_DOCS", 2)
    shard = token_shards._Shard(f"file://{tmp_path}", 5, "<u2")
    shard.add(None, b"\1\0")
    assert not shard.full()
    shard.add(0, b"\1\0\2\0")
    assert shard.full()
    rows = shard.close().to_pylist()
    assert [(r["key"], r["first"], r["count"], r["ids"]) for r in rows] == [(None, 0, 1, 1), (0, 1, 1, 2)]


def test_empty_table_and_unfit_tokenizer(spark, tmp_path):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    token_shards.write(none, f"file://{tmp_path}/none", word_bpe_file())
    assert token_shards.read(spark, f"file://{tmp_path}/none", none.select("doc_id"), unkeyed=True).collect() == []
    with pytest.raises(ValueError):
        token_shards.WordEncoder(word_bpe_file().replace("word_bpe_49k", "byte_bpe_50k"))


def test_query_matches_the_library(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    want, start = set(), 0
    for r in rows:
        ids = [*whole_ids(r["text"] or ""), 1]
        want.add((r["doc_id"], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = QUERIES["op11_token_shards"].run(spark, SMALL)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert set(map(tuple, got.collect())) == want and len(want) == len(rows)
