"""Texts of Arrow batches as numpy bytes: words, prefix hashes, bounded slices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that one numpy pass takes at most, unless one text alone is longer.
SLICE_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_WORD = ~_SPACE

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values; a bijection."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _base_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the base and of its inverse, modulo 2**64."""
    if len(_powers[0]) <= n:
        size = max(n + 1, SLICE_BYTES + 1)
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0][: n + 1], _powers[1][: n + 1]


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, and where each text begins; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, where, body = column.buffers()
    offsets = np.frombuffer(where, np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Batches cut so that each has at most ``limit`` bytes of text, or one row; with its bytes and offsets."""
    for batch in batches:
        data, offsets = utf8(batch.column(batch.schema.get_field_index(text)))
        begin = 0
        while begin < batch.num_rows:
            end = max(int(np.searchsorted(offsets, offsets[begin] + limit, "right")) - 1, begin + 1)
            end = min(end, batch.num_rows)
            yield batch.slice(begin, end - begin), data[offsets[begin] : offsets[end]], offsets[begin : end + 1] - offsets[begin]
            begin = end


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, all other bytes as they are."""
    return data + ((data - np.uint8(ord("A")) < 26).view(np.uint8) << 5)


def _marked(data: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """Whether each byte is marked in ``inside``; blanks are told by comparing, which costs less than looking up."""
    return (data != 0x20) & (data - np.uint8(0x09) >= 5) if inside is _WORD else inside[data]


def word_spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray = _WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, end and text number of every run of bytes marked in ``inside``: other than space and 0x09-0x0D."""
    word = np.zeros(len(data) + 2, bool)
    word[1:-1] = _marked(data, inside)
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(word[1:] & (~word[:-1] | edge))
    ends = np.flatnonzero(word[:-1] & (~word[1:] | edge))
    before = np.searchsorted(starts, offsets)
    return starts, ends, np.repeat(np.arange(-1, len(offsets)), np.diff(before, prepend=0, append=len(starts)))


def word_bytes(data: np.ndarray, inside: np.ndarray = _WORD) -> np.ndarray:
    """The bytes of all words, one after the other."""
    return data[_marked(data, inside)]


def numbered_words(body: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """A number for each word of ``body``, the same for equal words only, and the words by number."""
    where = np.concatenate(([0], np.cumsum(lengths))).astype(np.int64)
    column = pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(where), pa.py_buffer(body)])
    coded = column.dictionary_encode()
    return np.asarray(coded.indices).astype(np.int64), coded.dictionary


class PrefixHash:
    """64-bit hashes of any spans of some bytes in constant time each."""

    def __init__(self, data: np.ndarray):
        powers, self._inverse = _base_powers(len(data))
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[data] * powers[:-1], out=self._sums[1:])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of the bytes of each span; equal bytes have equal hashes wherever they are."""
        return mix((self._sums[ends] - self._sums[starts]) * self._inverse[starts])


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word."""
    return PrefixHash(data).spans(starts, ends)


def ngram_hashes(words: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every run of ``n`` words that stays within its text."""
    if len(words) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        total = mix(total + words[k : len(words) - n + 1 + k] * np.uint64(2 * k + 3))
    whole = doc[n - 1 :] == doc[: len(doc) - n + 1]
    return total[whole], doc[: len(doc) - n + 1][whole]
