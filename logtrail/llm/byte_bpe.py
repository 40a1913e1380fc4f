"""Byte-level BPE: encoding by batched matrix merges, and decoding.

A text is cut by the tokenizer's pattern; every piece is encoded on its own.
Pieces that a task has not seen before are grouped by length into padded
numpy matrices, a row per piece. In each round every row merges its leftmost
pair of minimum rank: ranks are looked up in a hash table of pairs, and rows
are compacted after the merge. Rows without a pair left are done.

Null and empty texts have no tokens. Any text round-trips: each byte is a
token. The memory of pieces already encoded is emptied when it is full, and at
the end of a task, as its process lives on; that changes nothing in the results.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StringType, StructField, StructType

from logtrail.llm.byte_text import slices
from logtrail.session import configure

#: Pieces whose ids a task remembers.
REMEMBERED = 120_000
#: Cells of one matrix.
CELLS = 1 << 20


class PairTable:
    """Open-addressing hash table from a pair of token ids to the id of their merge, as arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        self._bits = max(int(np.ceil(np.log2(max(len(left), 1) * 4))), 4)
        size = 1 << self._bits
        self._keys = np.full(size, -1, np.int64)
        self._values = np.full(size, -1, np.int32)
        keys = (left.astype(np.int64) << 32) | right
        slot = self._home(keys)
        todo = np.arange(len(keys))
        while len(todo):
            # Of the keys that want an empty slot, one gets it; the others and those at a full slot move on.
            free = self._keys[slot[todo]] == -1
            self._keys[slot[todo[free]]] = keys[todo[free]]
            placed = self._keys[slot[todo]] == keys[todo]
            self._values[slot[todo[placed]]] = merged[todo[placed]]
            todo = todo[~placed]
            slot[todo] = (slot[todo] + 1) & (size - 1)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self._bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Id of each merged pair, -1 where the pair does not merge."""
        keys = (left.astype(np.int64) << 32) | right
        slot = self._home(keys)
        held = self._keys[slot]
        found = np.where(held == keys, self._values[slot], -1)
        todo = np.flatnonzero((held != keys) & (held != -1))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & (len(self._keys) - 1)
            held = self._keys[slot[todo]]
            hit = held == keys[todo]
            found[todo[hit]] = self._values[slot[todo[hit]]]
            todo = todo[~hit & (held != -1)]
        return found


class Encoder:
    """Encodes and decodes by a file of ranks, each line a token in base64 and its rank."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        self._pattern = regex.compile(pattern)
        self._tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self._tokens[rank] = token
        self._bytes = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        left, right, merged = [], [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(rank)
        self._pairs = PairTable(*(np.array(x, np.int64) for x in (left, right, merged)))
        self._ids = list(range(len(self._tokens)))
        self._whole = {token: (self._ids[rank],) for token, rank in ranks.items()}
        self._known: dict[str, tuple] = {}
        self._full = False

    def merge_rows(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all pieces, one after the other, and where those of each begin; the pieces should be of similar length."""
        width = np.array([len(p) for p in pieces])
        rows, columns = len(pieces), int(width.max())
        ids = np.full((rows, columns), -1, np.int32)
        ids[np.arange(columns) < width[:, None]] = self._bytes[np.frombuffer(b"".join(pieces), np.uint8)]
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        number = np.arange(rows)
        none = np.iinfo(np.int32).max
        ranks = np.full((rows, columns), none, np.int32)
        real = np.arange(columns - 1) + 1 < width[:, None]
        found = self._pairs.find(ids[:, :-1][real], ids[:, 1:][real])
        ranks[:, :-1][real] = np.where(found < 0, none, found)
        while len(ids):
            best = ranks.argmin(1)  # the first of equal ranks is the leftmost
            value = ranks[np.arange(len(ids)), best]
            going = value < none
            if not going.all():
                ended = ~going
                done.append((number[ended], width[ended], ids[ended][np.arange(ids.shape[1]) < width[ended, None]]))
                ids, ranks, width, number = ids[going], ranks[going], width[going], number[going]
                best, value = best[going], value[going]
                if not len(ids):
                    break
            row = np.arange(len(ids))
            ids[row, best] = value
            # Close the gap after the merge.
            columns = ids.shape[1] - 1
            stays = np.ones(ids.shape, bool)
            stays[row, best + 1] = False
            ids = ids[stays].reshape(len(row), columns)
            ranks = ranks[stays].reshape(len(row), columns)
            width = width - 1
            for at in (best - 1, best):
                ok = (at >= 0) & (at + 1 < width)
                r, a = row[ok], at[ok]
                found = self._pairs.find(ids[r, a], ids[r, a + 1])
                ranks[r, a] = np.where(found < 0, none, found)
                end = (at >= 0) & (at + 1 >= width) & (at < columns)
                ranks[row[end], at[end]] = none
            if columns > int(width.max()):
                columns = max(int(width.max()), 1)
                ids, ranks = ids[:, :columns], ranks[:, :columns]
        number, width, flat = (np.concatenate(part) for part in zip(*done, strict=True))
        size = np.zeros(rows, np.int64)
        size[number] = width
        offsets = np.concatenate([[0], np.cumsum(size)])
        out = np.empty(offsets[-1], np.int32)
        out[np.repeat(offsets[number] - (np.cumsum(width) - width), width) + np.arange(len(flat))] = flat
        return out, offsets

    def _encode_pieces(self, pieces: list[bytes]) -> Iterator[tuple[int, tuple[int, ...]]]:
        """Number and token ids of each piece, by matrices of pieces of like length."""
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        order = np.argsort(size, kind="stable")
        size = size[order]
        begin = int(np.searchsorted(size, 0, "right"))
        yield from ((i, ()) for i in order[:begin].tolist())
        # One object per id, for all pieces that are remembered.
        shared = self._ids.__getitem__
        while begin < len(order):
            shortest = int(size[begin])
            end = int(np.searchsorted(size, shortest + shortest // 4 + 1, "right"))
            # Sizes grow, so the cells do too.
            cells = np.arange(1, end - begin + 1) * size[begin:end]
            end = begin + max(int(np.searchsorted(cells, CELLS, "right")), 1)
            chosen = order[begin:end].tolist()
            if len(chosen) == 1 and shortest > 256:
                yield chosen[0], tuple(map(shared, self._encode_long(pieces[chosen[0]]).tolist()))
            else:
                flat, offsets = self.merge_rows([pieces[i] for i in chosen])
                ids, cuts = tuple(map(shared, flat.tolist())), offsets.tolist()
                for i, first, last in zip(chosen, cuts[:-1], cuts[1:], strict=True):
                    yield i, ids[first:last]
            begin = end

    def _encode_long(self, piece: bytes) -> np.ndarray:
        """One long piece: all merges of the lowest rank at once, where they do not overlap.

        A merge only makes pairs with ranks of longer tokens, so the leftmost
        minimum pair of every round is the next of these, as one at a time.
        """
        ids = self._bytes[np.frombuffer(piece, np.uint8)]
        while len(ids) > 1:
            found = self._pairs.find(ids[:-1], ids[1:])
            if (found < 0).all():
                break
            best = found[found >= 0].min()
            at = np.flatnonzero(found == best)
            # In a run of overlapping pairs (a a a), every second one merges.
            run = np.concatenate([[True], np.diff(at) != 1])
            first = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - first) % 2 == 0]
            ids[at] = best
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            ids = ids[keep]
        return ids

    def _learn(self, words: set[str]) -> None:
        """Remember new pieces."""
        whole, rest, raw = self._whole, [], []
        for word in words:
            piece = word.encode()
            if piece in whole:
                self._known[word] = self._kept(whole[piece])
            else:
                rest.append(word)
                raw.append(piece)
        for k, ids in self._encode_pieces(raw):
            self._known[rest[k]] = self._kept(ids)

    def _kept(self, ids: tuple[int, ...]) -> tuple:
        """The ids of a piece, or what digests need: the ids as text, their number, and the decoded bytes."""
        return (" ".join(map(str, ids)), len(ids), self.decode(ids)) if self._full else ids

    def forget(self) -> None:
        """Empties the memory of pieces."""
        self._known = {}

    def decode(self, ids) -> bytes:
        """The bytes of token ids."""
        tokens = self._tokens
        return b"".join([tokens[i] for i in ids])

    def _ready(self, texts: list[str], full: bool) -> Iterator[list[tuple]]:
        """What is remembered of the pieces of each text; new pieces of all texts are encoded together."""
        if full != self._full:
            self.forget()
            self._full = full
        split = [self._pattern.findall(text) for text in texts]
        known = self._known
        new = {w for words in split for w in words if w not in known}
        if len(known) + len(new) > REMEMBERED:
            self._known = known = {}
            new = {w for words in split for w in words}
        self._learn(new)
        for words in split:
            yield [known[w] for w in words]

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Token ids of each text, special tokens' strings as ordinary text."""
        return [list(chain.from_iterable(parts)) for parts in self._ready(texts, False)]

    def digests(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """Number of tokens, SHA-256 of the ids as decimals with one space between, SHA-256 of the decoded bytes."""
        return [
            (
                sum([p[1] for p in parts]),
                hashlib.sha256(" ".join([p[0] for p in parts]).encode()).hexdigest(),
                hashlib.sha256(b"".join([p[2] for p in parts])).hexdigest(),
            )
            for parts in self._ready(texts, True)
        ]


@contextmanager
def for_task(path: str, pattern: str) -> Iterator[Encoder]:
    """The encoder of a file; what it has remembered is given back at the end."""
    use = encoder(path, pattern)
    try:
        yield use
    finally:
        use.forget()


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    """The encoder of a file, read once per process."""
    return Encoder(path, pattern)


def encode(documents: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """All columns, and the token ids of ``text`` as an array of int."""
    configure(documents.sparkSession)
    schema = StructType([*documents.drop(ids).schema.fields, StructField(ids, ArrayType(IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with for_task(path, pattern) as use:
            for rows, _, _ in slices(batches, text):
                found = use.encode([t or "" for t in rows.column(rows.schema.get_field_index(text)).to_pylist()])
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(found, pa.list_(pa.int32()))], [*rows.schema.names, ids])

    return documents.drop(ids).mapInArrow(run, schema)


def decode(tokens: DataFrame, path: str, pattern: str, ids: str = "token_ids", data: str = "decoded") -> DataFrame:
    """All columns, and the bytes that the ids stand for."""
    configure(tokens.sparkSession)
    schema = StructType([*tokens.drop(data).schema.fields, StructField(data, BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = encoder(path, pattern)
        for rows in (batch.slice(begin, 256) for batch in batches for begin in range(0, batch.num_rows, 256)):
            found = [use.decode(i or []) for i in rows.column(rows.schema.get_field_index(ids)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(found, pa.binary())], [*rows.schema.names, data])

    return tokens.drop(data).mapInArrow(run, schema)


def encode_checked(documents: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "token_ids", check: str = "decoded_sha256") -> DataFrame:
    """All columns but ``text``, its token ids, and the SHA-256 of what they decode to; encoded and decoded in one step."""
    configure(documents.sparkSession)
    others = documents.drop(text, ids, check)
    schema = StructType([*others.schema.fields, StructField(ids, ArrayType(IntegerType())), StructField(check, StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with for_task(path, pattern) as use:
            for rows, _, _ in slices(batches, text):
                at = rows.schema.get_field_index(text)
                found = use.encode([t or "" for t in rows.column(at).to_pylist()])
                sums = [hashlib.sha256(use.decode(i)).hexdigest() for i in found]
                kept = [k for k in range(rows.num_columns) if k != at]
                yield pa.RecordBatch.from_arrays([*(rows.column(k) for k in kept), pa.array(found, pa.list_(pa.int32())), pa.array(sums)], [*(rows.schema.names[k] for k in kept), ids, check])

    return documents.drop(ids, check).mapInArrow(run, schema)


def digests(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every text, encoded and decoded again."""
    configure(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with for_task(path, pattern) as use:
            for rows, _, _ in slices(batches):
                found = use.digests([t or "" for t in rows.column(1).to_pylist()])
                columns = [pa.array([f[k] for f in found], kind) for k, kind in enumerate((pa.int64(), pa.string(), pa.string()))]
                yield pa.RecordBatch.from_arrays([rows.column(0), *columns], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
