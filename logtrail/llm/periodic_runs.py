"""Runs of words that repeat with a period, found over a dictionary of basic factors.

A run is a longest stretch of consecutive words in which words ``q`` apart are
equal, ``q`` being its smallest period, of at least ``EXPONENT`` periods and
``LEAST`` words. The dictionary names, for each length L = 1, 2, 4, …, the
factors of L words of a text that occur in it again: a factor of 2 L words is
the pair of names of its halves, so only places whose halves both recur are
carried on, and ordinary text is done after a few lengths.

A place whose next occurrence of the same factor lies ``q`` ahead proposes the
period q. With L/2 < q <= L the two meet within twice the length, and then all
next occurrences along a run of period q are exactly q ahead: its root is no
power, so it does not fit itself at a smaller shift. Neighbouring places with
the same q are an arithmetic progression of occurrences; it begins where the
run begins, and ends L + q words before the run ends, as the words next to the
run break the factor on either side. Each q belongs to one L, so no run is
proposed twice, and a run of four periods is longer than L + q < 3 q.

Words are ``[^\\x20\\x09-\\x0D]+`` of the UTF-8 bytes, compared exactly.

* null or empty texts, and texts of blanks: no runs, the collapsed text is empty;
* repeated rows: each has its own result; ties do not occur;
* columns named like the results are replaced; all others stay as they are;
* an empty table gives an empty table;
* a text is worked on whole: some 30 bytes per byte of the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logtrail.llm.byte_text import numbered_words, slices, word_bytes, word_spans

#: Periods, and words, that a run has at least.
EXPONENT, LEAST = 4, 6

RUN_TYPE = "array<struct<start:bigint,length:bigint,period:bigint>>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def collapse(docs: DataFrame, text: str = "text", runs: str = "runs", collapsed: str = "collapsed", exponent: int = EXPONENT, least: int = LEAST) -> DataFrame:
    """The rows with their runs, in order of start and period, and the text without what runs repeat.

    A word goes if any run holds it after that run's first period; those that
    stay are joined by one space.
    """
    if exponent < 3:
        raise ValueError("a run needs three periods to be found at one length")
    kept = [f for f in docs.schema.fields if f.name not in (runs, collapsed)]
    if text not in [f.name for f in kept]:
        raise ValueError(f"no text column {text}")
    # Inside, columns go by number: names may hold dots.
    plain = [f"c{i}" for i in range(len(kept))]
    at = [f.name for f in kept].index(text)
    inner = T.StructType([T.StructField(n, f.dataType) for n, f in zip(plain, kept, strict=True)])
    inner = inner.add("runs", T._parse_datatype_string(RUN_TYPE)).add("collapsed", T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in slices(batches, f"c{at}"):
            found, texts = _slice(data, offsets, exponent, least)
            yield pa.RecordBatch.from_arrays([*batch.columns, found, texts], [*plain, "runs", "collapsed"])

    numbered = docs.select(*[F.col(_quoted(f.name)).alias(n) for n, f in zip(plain, kept, strict=True)])
    return numbered.mapInArrow(run, inner).toDF(*[f.name for f in kept], runs, collapsed)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _slice(data: np.ndarray, offsets: np.ndarray, exponent: int, least: int) -> tuple[pa.Array, pa.Array]:
    """Runs and collapsed text of each text of some bytes."""
    starts, ends, doc = word_spans(data, offsets)
    lengths = ends - starts
    rows, body = len(offsets) - 1, word_bytes(data)
    word, _ = numbered_words(body, lengths)
    begin, length, period = find_runs(word, doc, exponent, least)
    # Where a text's words and runs begin.
    first = np.searchsorted(doc, np.arange(rows + 1))
    of_run = np.searchsorted(begin, first)
    entries = pa.StructArray.from_arrays([pa.array(begin - first[doc[begin]] if len(begin) else begin), pa.array(length), pa.array(period)], fields=list(_RUN))
    found = pa.ListArray.from_arrays(pa.array(of_run, pa.int32()), entries)
    change = np.zeros(len(word) + 1, np.int64)
    np.add.at(change, begin + period, 1)
    np.add.at(change, begin + length, -1)
    stays = np.cumsum(change[:-1]) == 0
    return found, _joined(body[np.repeat(stays, lengths)], lengths[stays], np.searchsorted(doc[stays], np.arange(rows + 1)))


def _joined(body: np.ndarray, lengths: np.ndarray, first: np.ndarray) -> pa.Array:
    """Words joined by one space, per text; ``first`` numbers the first word of each text."""
    ends = np.concatenate(([0], np.cumsum(lengths + 1)))
    edges = ends[first]
    filled = edges[1:] > edges[:-1]
    out = np.full(int(ends[-1]), 0x20, np.uint8)
    blank = np.zeros(len(out), bool)
    blank[ends[1:] - 1] = True
    out[~blank] = body
    # Without the space behind the last word of each text.
    last = edges[1:][filled] - 1
    blank[:] = True
    blank[last] = False
    where = edges - np.concatenate(([0], np.cumsum(filled)))
    return pa.Array.from_buffers(pa.large_string(), len(first) - 1, [None, pa.py_buffer(where.astype(np.int64)), pa.py_buffer(out[blank])]).cast(pa.string())


def find_runs(word: np.ndarray, doc: np.ndarray, exponent: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, length and period of every run, by first word and period; ``doc`` is the text of each word."""
    n = len(word)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    if n:
        end = np.searchsorted(doc, doc, "right")
        place, name, size = np.arange(n), word, 1
        while len(place):
            place, name = _by_name(place, name)
            same = (name[1:] == name[:-1]) & (doc[place[1:]] == doc[place[:-1]])
            ahead = place[1:] - place[:-1]
            near = same & (ahead <= size) & (2 * ahead > size)
            found.append(_progressions(place[:-1][near], ahead[near], size, exponent, least))
            # The factors of twice the length at places where both halves recur.
            recurs = np.zeros(len(place), bool)
            recurs[1:] |= same
            recurs[:-1] |= same
            number = np.full(n, -1, np.int64)
            number[place[recurs]] = np.concatenate(([0], np.cumsum(~same)))[recurs]
            place = np.flatnonzero(number >= 0)
            place = place[place + 2 * size <= end[place]]
            place = place[number[place + size] >= 0]
            name = number[place] * (len(number) + 1) + number[place + size]
            size *= 2
    if not found:
        return (np.zeros(0, np.int64),) * 3
    begin, length, period = (np.concatenate(part) for part in zip(*found, strict=True))
    order = np.lexsort((period, begin))
    return begin[order], length[order], period[order]


def _by_name(place: np.ndarray, name: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and names sorted by name, then place."""
    bits = int(place[-1]).bit_length()
    if int(name.max()).bit_length() + bits < 63:
        packed = np.sort((name << bits) | place)
        return packed & ((1 << bits) - 1), packed >> bits
    order = np.argsort(name, kind="stable")
    return place[order], name[order]


def _progressions(place: np.ndarray, ahead: np.ndarray, size: int, exponent: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs from neighbouring places whose factor of ``size`` words recurs equally far ahead."""
    order = np.argsort(place)
    place, ahead = place[order], ahead[order]
    breaks = np.flatnonzero((np.diff(place) != 1) | (np.diff(ahead) != 0)) + 1
    first = np.concatenate(([0], breaks)) if len(place) else breaks
    last = np.concatenate((breaks, [len(place)])) - 1 if len(place) else breaks
    begin, period = place[first], ahead[first]
    length = place[last] + size + period - begin
    long = length >= np.maximum(least, exponent * period)
    return begin[long], length[long], period[long]
