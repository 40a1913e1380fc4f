"""Exact top-k by inner product over a bit-sliced index.

Components are quantised to integers. The index holds blocks of rows; of each
component it keeps one bitmap per binary digit (after the block's minimum is
taken off, so digits are unsigned). A score is a weighted sum of components:
the bitmaps of all digits of all components, each at its weight, are added by
carry-save adders, which are and, or and xor of whole bitmaps, for all rows
of a block at once. The bitmaps of the sum are then read from the most
significant down, which keeps sets of rows that are surely in the top k or
still equal to its boundary; rows left at the boundary are told apart by
their exact score and id.

Every block meets every block of queries: the queries are a stated set, and
each pair of blocks is one row of work. Vectors that are null, or hold a null
or a number that is not finite, take no part, nor do rows without an id;
shorter vectors count as padded with zeros. A query never meets rows of its
own id. Repeated ids are rows of their own. Scores must fit a bigint.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logtrail.session import configure, scratch_path

#: Rows of an index block, and queries of a query block.
BLOCK_ROWS, BLOCK_QUERIES = 16384, 64
_WORD = 64


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * component) of each component as bigint."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """A row of integers per list, padded with zeros."""
    lengths = np.asarray(column.value_lengths())
    out = np.zeros((len(column), int(lengths.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = np.asarray(column.flatten())
    return out


def slice_bits(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bitmaps (one per digit of each component), digits per component, and minimum per component."""
    low = values.min(0)
    shifted = (values - low).astype(np.uint64)
    digits = np.array([int(m).bit_length() for m in shifted.max(0)])
    words = -(-len(values) // _WORD)
    padded = np.zeros((words * _WORD, values.shape[1]), np.uint64)
    padded[: len(values)] = shifted
    maps = [np.packbits(((padded[:, d] >> np.uint64(s)) & np.uint64(1)).astype(bool), bitorder="little").view(np.uint64) for d in range(values.shape[1]) for s in range(digits[d])]
    return np.array(maps, np.uint64).reshape(-1, words), digits, low


def add_slices(levels: dict[int, list[np.ndarray]]) -> list[np.ndarray]:
    """The sum of bitmaps, each counted 2**level times, as bitmaps from the lowest digit up."""
    out, level = [], 0
    while levels:
        stack = levels.pop(level, [])
        width = stack[0].shape[-1] if stack else 0
        rows = np.concatenate([s.reshape(-1, width) for s in stack]) if stack else None
        while rows is not None and len(rows) > 1:
            third = len(rows) // 3
            if third:
                a, b, c = rows[:third], rows[third : 2 * third], rows[2 * third : 3 * third]
                ab = a ^ b
                carry = (a & b) | (c & ab)
                rows = np.concatenate([ab ^ c, rows[3 * third :]])
            else:
                carry, rows = (rows[0] & rows[1])[None], (rows[0] ^ rows[1])[None]
            levels.setdefault(level + 1, []).append(carry)
        out.append(None if rows is None else rows[0])
        level += 1
    return out


def _spread(bits: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bits.view(np.uint8), bitorder="little"))


class Block:
    """Bitmaps of some rows, sorted by id."""

    def __init__(self, ids: np.ndarray, maps: np.ndarray, digits: np.ndarray, low: np.ndarray):
        self.ids, self._maps, self._digits, self._low = ids, maps, digits, low
        self._first = np.concatenate([[0], np.cumsum(digits)]).astype(int)
        self._words = maps.shape[1] if len(maps) else -(-len(ids) // _WORD)
        all_rows = np.zeros(self._words * _WORD, bool)
        all_rows[: len(ids)] = True
        self._all = np.packbits(all_rows, bitorder="little").view(np.uint64)

    def scores(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Bitmaps of sum - constant for all rows, and the constant."""
        width = min(len(query), len(self._digits))
        weights, constant = query[:width], int(sum(int(q) * int(m) for q, m in zip(query[:width], self._low[:width], strict=True)))
        levels: dict[int, list[np.ndarray]] = {}
        for negative in (False, True):
            chosen = np.flatnonzero(weights < 0 if negative else weights > 0)
            size = np.abs(weights[chosen])
            if negative:
                # -w * u is w * (all ones - u) less a constant; all ones - u is the inverted bitmap.
                constant -= int(sum(int(w) * ((1 << int(self._digits[d])) - 1) for w, d in zip(size, chosen, strict=True)))
            for s in range(int(self._digits[chosen].max(initial=0))):
                has = self._digits[chosen] > s
                rows = self._maps[self._first[chosen[has]] + s]
                rows = ~rows if negative else rows
                for t in range(int(size[has].max(initial=0)).bit_length()):
                    at = (size[has] >> t) & 1 == 1
                    if at.any():
                        levels.setdefault(s + t, []).append(rows[at])
        if levels and max(levels) > 55:
            raise ValueError("scores do not fit a bigint")
        return add_slices(levels), constant

    def top(self, own: int, query: np.ndarray, k: int) -> list[tuple[int, int]]:
        """(score, id) of the k best rows, the smaller id of equal scores first."""
        slices, constant = self.scores(query)
        equal = self._all.copy()
        for at in range(int(np.searchsorted(self.ids, own, "left")), int(np.searchsorted(self.ids, own, "right"))):
            equal[at // _WORD] &= ~(np.uint64(1) << np.uint64(at % _WORD))
        sure = np.zeros_like(equal)
        done = False
        for bits in reversed(slices):
            if bits is None:
                continue
            both = sure | (equal & bits)
            count = int(np.bitwise_count(both).sum())
            if count > k:
                equal &= bits
            else:
                sure, equal = both, equal & ~bits
                if count == k:
                    done = True
                    break
        rows = _spread(sure)
        if not done:  # rows at the boundary are equal in score; ids are in order
            rows = np.concatenate([rows, _spread(equal)[: k - len(rows)]])
        score = np.full(len(rows), constant, np.int64)
        for level, bits in enumerate(slices):
            if bits is not None:
                score += ((bits[rows // _WORD] >> (rows % _WORD).astype(np.uint64)) & np.uint64(1)).astype(np.int64) << level
        return sorted(zip((-score).tolist(), self.ids[rows].tolist(), strict=True))


_BLOCK = "block bigint, ids binary, maps binary, digits binary, low binary"
_ROWS = "numbers array<bigint>"


def index(vectors: DataFrame) -> DataFrame:
    """Blocks of ``id bigint, numbers array<bigint>``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []

        def block() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            ids, values = np.asarray(table.column("id")), matrix(table.column("numbers").combine_chunks())
            order = np.argsort(ids, kind="stable")
            maps, digits, low = slice_bits(values[order]) if values.shape[1] else (np.zeros((0, -(-len(ids) // _WORD)), np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
            parts = (ids[order], maps, digits.astype(np.int64), low)
            return pa.RecordBatch.from_arrays([pa.array([part << 32 | made], pa.int64()), *(pa.array([p.tobytes()], pa.binary()) for p in parts)], ["block", "ids", "maps", "digits", "low"])

        for batch in batches:
            while batch.num_rows:
                room = BLOCK_ROWS - sum(b.num_rows for b in held)
                held.append(batch.slice(0, room))
                batch = batch.slice(room)
                if sum(b.num_rows for b in held) == BLOCK_ROWS:
                    yield block()
                    held, made = [], made + 1
        if held:
            yield block()

    return vectors.select("id", "numbers").mapInArrow(run, _BLOCK)


def top_k(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score of the k best rows of ``vectors`` for each row of ``queries`` (both ``id, numbers``)."""
    spark = configure(vectors.sparkSession)
    place = scratch_path(spark, "bit-slices")
    index(vectors).write.parquet(place)
    blocks = spark.read.parquet(place)
    names = blocks.select("block")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, BLOCK_QUERIES):
                part = batch.slice(begin, BLOCK_QUERIES)
                yield pa.RecordBatch.from_arrays([pa.array([part.column(0).to_pylist()], pa.list_(pa.int64())), pa.array([part.column(1).to_pylist()], pa.list_(pa.list_(pa.int64())))], ["query_ids", "query_numbers"])

    packed = queries.select("id", "numbers").mapInArrow(pack, "query_ids array<bigint>, query_numbers array<array<bigint>>")
    # A row per pair of blocks: the names of all blocks (one per BLOCK_ROWS rows) are the key that queries are dealt to.
    listed = [r["block"] for r in names.collect()]
    dealt = packed.withColumn("block", F.explode(F.lit(listed).cast("array<bigint>")))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids, maps, digits, low = (np.frombuffer(batch.column(name)[row].as_buffer(), t) for name, t in (("ids", np.int64), ("maps", np.uint64), ("digits", np.int64), ("low", np.int64)))
                words = -(-len(ids) // _WORD)
                block = Block(ids, maps.reshape(-1, words), digits, low)
                found: list[tuple[int, int, int]] = []
                for own, numbers in zip(batch.column("query_ids")[row].as_py(), batch.column("query_numbers")[row].as_py(), strict=True):
                    found += [(own, at, -score) for score, at in block.top(own, np.array(numbers, np.int64), k)]
                yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in range(3)], ["query_id", "vec_id", "score"])

    found = dealt.join(blocks, "block").mapInArrow(search, "query_id bigint, vec_id bigint, score bigint")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
