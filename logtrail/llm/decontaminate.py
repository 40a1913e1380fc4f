"""Finds benchmark passages in documents, edited ones too.

Windows are parts of a document, as long as an item. They and the items are
embedded by random walks: a shared coin per step and symbol says whether the
walk advances in its text, and the symbols it reads form the embedding, so
texts with a small edit distance get embeddings with a small Hamming distance.

1. *Search.* A walk begins at every word of a text, and at every byte of words
   over ``LONG`` bytes, as of texts without blanks. Steps of its first ``STEPS``
   are sampled repeatedly, several at a time, and each sample is looked up among
   those of the walks that begin at the words of the items. What agrees lines the
   item up with the text: the window begins where the item does.
2. *Bounds.* Of the item, cut into strings of three bytes, no more may be missing around the window than there may
   be edits: that rules out most windows at little cost. The sum of the least edits of an item's pieces, each where it fits best,
   is no more than the edits of the item: windows above ``share`` are left out.
3. *Agreement.* Steps of the whole walk over the window are sampled, ``BITS`` at a
   time, in as many repetitions as the target recall needs; a window that
   agrees in one whole sample goes on.
4. *Verification* by the exact edit distance to the item, best alignment included.

Texts are compared in lower case (A-Z) with single blanks, byte by byte. An
item is found when the distance is at most ``share`` of its length. Null and
empty texts and items hold nothing. Items that share their text are found
together, repeated documents each by itself. Documents are treated one by one
and whole; items are sent to tasks in parts of at most ``ITEMS``, so what a
task holds is bounded however many there are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtrail.llm.byte_text import lower_ascii, mix, slices, word_bytes, word_spans
from logtrail.session import configure

#: Symbols sampled at a time, for agreement; items in one part, and all their bytes in one part together.
BITS = 3
ITEMS, ITEM_BYTES = 20_000, 2 << 20
#: Search: first steps of a walk that are sampled, by the bytes that are left of the item (a walk of so many steps
#: stays within them); samples; bytes of words that are searched byte by byte, and of
#: the stride there in items; candidates in one numpy pass, and places of a text that are searched before them; places
#: whose keys are made at once, so few that they stay in a core's cache.
STEPS, SAMPLES, LONG, STRIDE, PASS, PLACES, AT_ONCE = (64, 32, 16, 8, 4, 2, 1), 16, 32, 8, 1 << 16, 1 << 14, 1 << 14
#: Bytes of an item's pieces in the lower bound of its edits.
PIECE = 64
#: Bytes of a block in the bound before that, numbers of three-byte strings, windows searched equally far from which that
#: bound is worth while, and lookups in one numpy pass.
BLOCK, CODES, GROUP, LOOKUPS = 8, 1 << 10, 16, 1 << 14
#: Part of an item's bytes that may be edited; share of embedded symbols that such edits may change; wanted recall.
SHARE, CHANGED, RECALL = 0.2, 0.6, 0.98
#: Steps of the walk per byte of the item.
STRETCH = 3


def repetitions(bits: int = BITS, changed: float = CHANGED, recall: float = RECALL) -> int:
    """Samples needed so that one agrees with the wanted probability."""
    return math.ceil(math.log(1 - recall) / math.log(1 - (1 - changed) ** bits))


def normal(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased words with one blank after each: bytes, offsets of texts, and first byte, end and text of each word."""
    data = lower_ascii(data)
    starts, ends, doc = word_spans(data, offsets)
    length = ends - starts + 1
    begin = np.concatenate([[0], np.cumsum(length)])
    inside = np.ones(begin[-1], bool)
    inside[begin[1:] - 1] = False
    out = np.full(begin[-1], 0x20, np.uint8)
    out[inside] = word_bytes(data)
    return out, begin[np.searchsorted(doc, np.arange(len(offsets)))], begin[:-1], begin[1:] - 1, doc


@lru_cache(64)
def coins(block: int, seed: int = 11) -> np.ndarray:
    """The walk's coins, advance or stay, per symbol and step of a block of 256 steps."""
    rows = mix(np.arange(block << 16, (block + 1) << 16, dtype=np.uint64) + np.uint64(seed << 40))
    return ((rows >> np.uint64(17)) & np.uint64(1)).astype(np.int8).reshape(256, 256)


@lru_cache(1)
def wide_coins() -> np.ndarray:
    """The first coins, as wide as places are."""
    return coins(0).astype(np.intp)


def embed(data: np.ndarray, begin: np.ndarray, end: np.ndarray, samples: np.ndarray) -> np.ndarray:
    """Symbols that the walks over some spans read at the sampled steps, a row each; 0 after a span's end."""
    flat = samples.reshape(len(begin), -1)
    out = np.zeros(flat.shape, np.uint8)
    if not flat.size:
        return out.reshape(samples.shape)
    # Spans with the fewest steps first: those whose last sample is taken drop out.
    order = np.argsort(flat.max(1), kind="stable")
    last_step = flat.max(1)[order]
    row, column = np.unravel_index(np.argsort(flat[order], axis=None, kind="stable"), flat.shape)
    step = flat[order[row], column]
    at, end, last = begin[order].copy(), end[order], len(data) - 1
    first = taken = 0
    for j in range(int(last_step[-1]) + 1):
        while last_step[first] < j:
            first += 1
        here = at[first:]
        symbol = np.where(here < end[first:], data[np.minimum(here, last)], 0)
        to = taken
        if step[taken] == j:
            to = int(np.searchsorted(step, j, "right"))
            out[order[row[taken:to]], column[taken:to]] = symbol[row[taken:to] - first]
        taken = to
        here += coins(j >> 8)[j & 255, symbol]
    return out.reshape(samples.shape)


def best_alignment(item: bytes, text: bytes) -> tuple[int, int]:
    """Least edit distance of the item to any part of the text, and where that part ends (bit-parallel)."""
    masks: dict[int, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    n = len(item)
    full, top = (1 << n) - 1, 1 << (n - 1)
    plus, minus, score = full, 0, n
    best, where = n, 0
    for j, c in enumerate(text):
        x = masks.get(c, 0) | minus
        d0 = (((x & plus) + plus) ^ plus) | x
        hp = minus | ~(d0 | plus) & full
        hn = plus & d0
        if hp & top:
            score += 1
        elif hn & top:
            score -= 1
        hp = hp << 1 & full
        hn = hn << 1 & full
        plus = hn | ~(d0 | hp) & full
        minus = hp & d0
        if score < best:
            best, where = score, j + 1
    return best, where


@dataclass(frozen=True)
class Items:
    """Some items: numbers, normal text, keys of the search in order with item and place, the sampled steps, and the embeddings there only."""

    ids: list
    data: np.ndarray
    offsets: np.ndarray
    keys: np.ndarray
    key_item: np.ndarray
    key_at: np.ndarray
    known: np.ndarray
    looks: tuple[tuple[int, int, tuple[int, ...]], ...]
    samples: np.ndarray
    embedded: np.ndarray
    gram_code: np.ndarray
    string_row: np.ndarray
    string_at: np.ndarray
    string_bit: np.ndarray
    share: float

    @property
    def length(self) -> np.ndarray:
        return np.diff(self.offsets)

    @classmethod
    def of(cls, rows: list[tuple[int, str]], share: float = SHARE, seed: int = 5) -> Items:
        raw = [(text or "").encode() for _, text in rows]
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
        data, bounds, starts, ends, doc = normal(np.frombuffer(b"".join(raw), np.uint8), offsets)
        words = np.bincount(doc, minlength=len(rows)) if len(rows) else np.zeros(0, int)
        # The blank after the last word is no part of an item.
        keep = np.flatnonzero(words)
        spans = [(int(bounds[k]), int(bounds[k + 1]) - 1) for k in keep]
        number = np.full(len(rows), -1)
        number[keep] = np.arange(len(keep))
        new = np.concatenate([data[a:b] for a, b in spans]) if spans else np.zeros(0, np.uint8)
        offsets = np.concatenate([[0], np.cumsum([b - a for a, b in spans])]).astype(np.int64)
        steps = STRETCH * np.diff(offsets)
        # Fractions of an item's own walk, so that samples spread over short and long items alike.
        rng = np.random.default_rng(seed)
        fractions = rng.random((repetitions(), BITS))
        samples = (fractions[None] * steps[:, None, None]).astype(np.int64)
        embedded = np.zeros(samples.shape, np.uint8)
        for part in _by_length(steps):
            embedded[part] = embed(new, offsets[:-1][part], offsets[1:][part], samples[part])
        at, of = window_begins(starts, ends, doc, STRIDE)
        item, place = number[of], at - bounds[of]
        keys, key_item, key_at, known, looks = _search_keys(new, offsets, item, place)
        return cls([rows[k][0] for k in keep], new, offsets, keys, key_item, key_at, known, looks, samples, embedded, *_strings(new, offsets), share)


def _by_length(length: np.ndarray) -> list[np.ndarray]:
    """Numbers in parts of some 8,000 of similar length."""
    order = np.argsort(length, kind="stable")
    return [part for part in np.array_split(order, max(1, len(order) // 8192)) if len(part)]


def window_begins(starts: np.ndarray, ends: np.ndarray, doc: np.ndarray, stride: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """First byte and text number of each window to look at: at words, and within long words at every ``stride`` bytes."""
    count = np.where(ends - starts > LONG, -(-(ends - starts) // stride), 1)
    inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return np.repeat(starts, count) + inside * stride, np.repeat(doc, count)


def first_symbols(data: np.ndarray, at: np.ndarray, steps: int) -> np.ndarray:
    """What the walks that begin at some places read in their first steps, a row per step."""
    # A walk reads no further than one byte a step; behind the end it reads zeros.
    low, high = (int(at.min()), int(at.max()) + steps) if len(at) else (0, 0)
    data = np.concatenate([data[low:high], np.zeros(steps, np.uint8)])
    out, here = np.empty((steps, len(at)), np.uint8), at - low
    symbol = np.empty(len(at), np.uint8)
    for j in range(steps):
        data.take(here, out=symbol, mode="clip")
        out[j] = symbol
        here += wide_coins()[j].take(symbol, mode="clip")
    return out


@lru_cache(1)
def _weights(seed: int = 13) -> np.ndarray:
    """An odd number per step."""
    return (mix(np.arange(STEPS[0], dtype=np.uint64) + np.uint64(seed << 40)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


@lru_cache(1)
def _salts(seed: int = 17) -> np.ndarray:
    """A number per sample."""
    return (mix(np.arange(len(STEPS) * SAMPLES, dtype=np.uint64) + np.uint64(seed << 40)) >> np.uint64(32)).astype(np.uint32)


def _weighted(symbols: np.ndarray) -> np.ndarray:
    """The symbols times their step's number: what keys are summed up from."""
    return symbols * _weights()[: len(symbols), None]


def _keys(weighted: np.ndarray, number: int, steps: tuple[int, ...]) -> np.ndarray:
    """The sampled symbols of each walk, and the sample's number, as one 32-bit key with well spread upper bits.

    A sum modulo 2**32 of odd multiples; what is equal by chance is ruled out by what follows.
    """
    key = weighted[steps[0]] + _salts()[number]
    for j in steps[1:]:
        key += weighted[j]
    return key


def _slots(keys: np.ndarray, size: int) -> np.ndarray:
    return (keys >> np.uint32(33 - size.bit_length())).astype(np.intp)


def _search_keys(data: np.ndarray, offsets: np.ndarray, item: np.ndarray, place: np.ndarray, seed: int = 7):
    """Keys in order, their item and place, a table per sample of what keys there may be, and the samples as (number, bytes needed, steps)."""
    length = np.diff(offsets)[item]
    left = length - place
    # Short items have fewer places to be found at, so fewer steps have to agree, and half as many at their ends.
    steps = -np.array(STEPS)
    most = np.where(length >= 192, 64, np.where(length >= 64, 32, 16))
    reach = -steps[np.searchsorted(steps, -np.minimum(left, most))] if len(left) else left
    least = -steps[np.searchsorted(steps, -np.minimum(length, np.where(length >= 64, most, most // 2)))] if len(left) else left
    rng = np.random.default_rng(seed)
    weighted = _weighted(first_symbols(data, offsets[item] + place, STEPS[0]))
    found, looks = [(np.zeros(0, np.uint32), np.zeros(0, np.int64))], []
    for need in STEPS:
        chosen = np.flatnonzero((reach == need) & (reach >= least))
        look = min(need // 5 + 2 if need > 16 else 7, max(need - 2, 1))
        drawn = {tuple(sorted(rng.choice(need, look, replace=False).tolist())) for _ in range(SAMPLES)}
        for steps in sorted(drawn) if len(chosen) else ():
            found.append((_keys(weighted[:, chosen], len(looks), steps), chosen))
            looks.append((len(looks), need, steps))
    # A small table per sample: one stays in cache while its sample is looked up.
    known = np.zeros((len(looks), 1 << min(max(11, (16 * max(len(part) for part, _ in found)).bit_length()), 24)), bool)
    for number, (part, _) in enumerate(found[1:]):
        known[number, _slots(part, known.shape[1])] = True
    keys, of = (np.concatenate(part) for part in zip(*found, strict=True))
    order = np.argsort(keys, kind="stable")
    return keys[order], item[of[order]].astype(np.int32), place[of[order]].astype(np.int32), known, tuple(looks)


def candidates(items: Items, data: np.ndarray, at: np.ndarray, doc: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Text number, item number and first byte of each window that lines up with an item, by passes; some come twice."""
    for first in range(0, len(at), PLACES):
        yield from _candidates(items, data, at[first : first + PLACES], doc[first : first + PLACES])


def _candidates(items: Items, data: np.ndarray, at: np.ndarray, doc: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    hits, rows = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
    for first in range(0, len(at), AT_ONCE):
        weighted = _weighted(first_symbols(data, at[first : first + AT_ONCE], STEPS[0]))
        for number, _, steps in items.looks:
            keys = _keys(weighted, number, steps)
            hit = np.flatnonzero(items.known[number].take(_slots(keys, items.known.shape[1]), mode="clip"))
            hits.append(keys[hit])
            rows.append(hit + first)
    # In order of keys, a search costs little.
    both = np.sort(np.concatenate(hits).astype(np.uint64) << np.uint64(32) | np.concatenate(rows).astype(np.uint64))
    keys, where = (both >> np.uint64(32)).astype(np.uint32), (both & np.uint64(0xFFFFFFFF)).astype(np.int64)
    low = np.searchsorted(items.keys, keys, "left")
    there = np.flatnonzero(items.keys[np.minimum(low, len(items.keys) - 1)] == keys)
    where, low = where[there], low[there]
    count = np.searchsorted(items.keys, keys[there], "right") - low
    # In order of places, so that what samples have in common falls into one pass.
    order = np.argsort(where, kind="stable")
    where, low, count = where[order], low[order], count[order]
    ends = np.cumsum(count)
    first = 0
    while first < len(where):
        last = max(int(np.searchsorted(ends, (ends[first - 1] if first else 0) + PASS, "right")), first + 1)
        n = count[first:last]
        which = np.repeat(low[first:last], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        window = np.repeat(where[first:last], n)
        yield _once(doc[window], items.key_item[which].astype(np.int64), at[window] - items.key_at[which])
        first = last


def _once(doc: np.ndarray, item: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows in order of their first byte, hardly any twice."""
    key = begin * (int(item.max(initial=0)) + 1) + item
    order = np.argsort(key)
    key, doc = key[order], doc[order]
    new = np.append(True, (key[1:] != key[:-1]) | (doc[1:] != doc[:-1]))[: len(key)]
    return doc[new], item[order[new]], begin[order[new]]


def agree(items: Items, data: np.ndarray, item: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Whether each window agrees with its item in one whole sample of the embedding."""
    ok = np.zeros(len(item), bool)
    for part in _by_length(items.length[item]):
        walks = embed(data, begin[part], end[part], items.samples[item[part]])
        ok[part] = (walks == items.embedded[item[part]]).all(2).any(1)
    return ok


_BITS = np.left_shift(1, np.arange(8)).astype(np.uint8)


def grams(data: np.ndarray) -> np.ndarray:
    """16 bits of a hash of the three bytes that begin at each place."""
    data = np.concatenate([data, np.zeros(2, np.uint8)]).astype(np.uint32)
    return ((data[:-2] << 16 | data[1:-1] << 8 | data[2:]) * np.uint32(0x9E3779B1) >> np.uint32(16)).astype(np.intp)


def _strings(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A number below ``CODES`` for each hash of three bytes, 0 if no item is cut into these; and of each item's strings, in
    rows of 64: its first row; their places in a row of blocks; their bits.

    The commonest strings do not share a number. Those that are rare come first: where an item is not, they tell soonest.
    The last row of an item is filled up by ones without a bit.
    """
    many = np.diff(offsets) // 3
    first = np.concatenate([[0], np.cumsum(-(-many // 64))])
    item = np.repeat(np.arange(len(many)), many)
    number = np.arange(many.sum()) - (np.cumsum(many) - many)[item]
    gram = grams(data)[offsets[item] + 3 * number] if len(item) else item
    times = np.bincount(gram, minlength=1 << 16)
    common = np.argsort(-times, kind="stable")[: np.count_nonzero(times)]
    code = np.zeros(1 << 16, np.intp)
    code[common] = 1 + np.arange(len(common)) % (CODES - 1)
    order = np.lexsort((times[gram], item))
    to = 64 * first[item] + number
    at, bit = np.zeros(64 * first[-1], np.intp), np.zeros(64 * first[-1], np.uint8)
    at[to] = (3 * number // BLOCK * (CODES // 8) + (code[gram] >> 3))[order]
    bit[to] = _BITS[code[gram] & 7][order]
    return code, first, at.reshape(-1, 64), bit.reshape(-1, 64)


def plausible(items: Items, data: np.ndarray, item: np.ndarray, begin: np.ndarray, slack: np.ndarray) -> np.ndarray:
    """Windows in which enough of the item occurs, cut into strings of three bytes: an edit spoils one of them at most.

    Each string is looked for as far away as the edits may have shifted it, in whole blocks of ``BLOCK`` bytes, so that
    more is found than there is. A bound that costs a fraction of that of pieces, and mostly suffices. Windows of all
    items that are searched equally far are treated together, in order of their places; few of a kind are left to the
    bound of pieces.
    """
    wide = (2 * slack + BLOCK - 1) // BLOCK + 2
    # Windows come nearly in order of their places, which keeps together what they look up.
    order = np.argsort(wide.astype(np.int16), kind="stable")
    many = np.bincount(wide, minlength=1)
    kept, order = [order[many[wide[order]] < GROUP]], order[many[wide[order]] >= GROUP]
    if not len(order):
        return np.sort(kept[0])
    item, begin, slack, wide = item[order], begin[order], slack[order], wide[order]
    first = int((begin - slack).min()) // BLOCK
    blocks = int((begin + items.length[item] + slack).max()) // BLOCK + 2 - first
    at = np.arange(max(first * BLOCK, 0), min((first + blocks) * BLOCK, len(data) - 2))
    code = items.gram_code.take(grams(data[at[0] : at[-1] + 3])[: len(at)]) if len(at) else at
    row = CODES // 8
    # Bits of the strings that begin within 1, 2, 4 ... blocks in a row: two of these make up any number of blocks.
    spans = [np.zeros((blocks, row), np.uint8)]
    np.bitwise_or.at(spans[0].reshape(-1), (at // BLOCK - first) * row + (code >> 3), _BITS.take(code & 7))
    start = ((begin - slack) // BLOCK - first) * row
    ends, table = np.flatnonzero(np.append(wide[1:] != wide[:-1], True)) + 1, np.empty_like(spans[0])
    for lo, hi in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True):
        far = int(wide[lo])
        while 2 << len(spans) - 1 <= far:
            spans.append(_joined(spans[-1], 1 << len(spans) - 1, np.empty_like(table)))
        _joined(spans[far.bit_length() - 1], far - (1 << far.bit_length() - 1), table)
        kept += [order[some[_enough(items, table.reshape(-1), item[some], start[some], slack[some])]] for some in _ranges(lo, hi, LOOKUPS // 64)]
    return np.sort(np.concatenate(kept))


def _ranges(lo: int, hi: int, size: int) -> Iterator[np.ndarray]:
    for first in range(lo, hi, size):
        yield np.arange(first, min(first + size, hi))


def _enough(items: Items, table: np.ndarray, item: np.ndarray, start: np.ndarray, slack: np.ndarray) -> np.ndarray:
    """Windows of which no more strings are missing than there may be edits; 64 strings at a time."""
    left, k, kept = np.arange(len(item)), 0, []
    # Strings that may be missing yet; those of the rows' ends have no bit and are no loss.
    spare, strings = slack.copy(), items.length[item] // 3
    while len(left):
        done = strings[left] <= 64 * k
        kept.append(left[done])
        left = left[~done]
        at = items.string_row[item[left]] + k
        place = items.string_at.take(at, axis=0)
        place += start[left, None]
        held = table.take(place, mode="clip")
        held &= items.string_bit.take(at, axis=0)
        k += 1
        spare[left] -= np.minimum(strings[left] - 64 * (k - 1), 64) - np.bitwise_count(np.packbits(held, axis=1).view(np.uint64))[:, 0]
        left = left[spare[left] >= 0]
    return np.concatenate(kept) if kept else left


def _joined(rows: np.ndarray, by: int, out: np.ndarray) -> np.ndarray:
    """The bits of each row, and of the row ``by`` further."""
    np.bitwise_or(rows[: len(rows) - by], rows[by:], out=out[: len(rows) - by])
    out[len(rows) - by :] = rows[len(rows) - by :]
    return out


def bounded(items: Items, data: np.ndarray, item: np.ndarray, begin: np.ndarray, low: np.ndarray, high: np.ndarray, slack: np.ndarray) -> np.ndarray:
    """Windows whose item may have no more than ``slack`` edits: the least edits of its pieces add up to no more.

    A piece is shifted by no more than the edits between it and where the window lined up, so it is looked for there
    only. Twice as many pieces are taken each round, and windows that are above already drop out.
    """
    length = items.length[item]
    per = -(-length // PIECE)
    total, left, k = np.zeros(len(item), np.int64), np.arange(len(item)), 0
    out = []
    while len(left):
        many = np.minimum(per[left], max(2 * k, 1)) - k
        w = np.repeat(left, many)
        piece = k + np.arange(len(w)) - np.repeat(np.cumsum(many) - many, many)
        # Pieces of one item are of the same size, but for one byte.
        at, end = piece * length[w] // per[w], (piece + 1) * length[w] // per[w]
        start, stop = np.maximum(begin[w] + at - slack[w], low[w]), np.minimum(begin[w] + end + slack[w], high[w])
        for lanes in _by_length(stop - start):
            v = w[lanes]
            np.add.at(total, v, _best_pieces(items.data, items.offsets[item[v]] + at[lanes], (end - at)[lanes], data, start[lanes], stop[lanes]))
        k = max(2 * k, 1)
        left = left[total[left] <= slack[left]]
        done = per[left] <= k
        out.append(left[done])
        left = left[~done]
    return np.sort(np.concatenate(out)) if out else left


def _distinct(*columns: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct rows in order, by the first column first."""
    order = np.lexsort(columns[::-1])
    columns = tuple(c[order] for c in columns)
    new = np.ones(len(order), bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return tuple(c[new] for c in columns)


def _best_pieces(pattern: np.ndarray, first: np.ndarray, size: np.ndarray, data: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Least edit distance of each piece of up to 64 bytes to any part of its text: one lane of bits each, all lanes at once."""
    _, kept, kind = np.unique(first, return_index=True, return_inverse=True)
    # A piece lies in the upper bits, so that the sign tells its last row. The bits below fit any byte, and stay at no edits.
    free = (64 - size[kept]).astype(np.uint64)
    rest = (np.uint64(1) << free) - np.uint64(1)
    masks = np.repeat(rest[:, None], 256, 1)
    for j in range(int(size.max(initial=0))):
        inside = np.flatnonzero(size[kept] > j)
        masks[inside, pattern[first[kept][inside] + j]] |= np.uint64(1) << (free[inside] + np.uint64(j))
    masks, row, one = masks.ravel(), kind * 256, np.uint64(1)
    plus, minus = ~rest[kind], np.zeros(len(first), np.uint64)
    score, best, at = size.astype(np.int64), size.astype(np.int64), low.copy()
    x, d0, hp, hn = (np.empty(len(first), np.uint64) for _ in range(4))
    up, place = np.empty(len(first), np.int64), np.empty(len(first), np.int64)
    for _ in range(int((high - low).max(initial=0))):
        # Behind its end a text goes on with what follows; a bound it stays, as more text only lowers it.
        np.add(row, data.take(at, mode="clip"), out=place)
        masks.take(place, out=x, mode="clip")
        at += 1
        x |= minus
        np.bitwise_and(x, plus, out=d0)
        d0 += plus
        d0 ^= plus
        d0 |= x
        np.bitwise_or(d0, plus, out=hp)
        np.invert(hp, out=hp)
        hp |= minus
        np.bitwise_and(plus, d0, out=hn)
        score -= np.right_shift(hp.view(np.int64), 63, out=up)
        score += np.right_shift(hn.view(np.int64), 63, out=up)
        np.left_shift(hp, one, out=hp)
        np.left_shift(hn, one, out=hn)
        np.bitwise_and(hp, d0, out=minus)
        d0 |= hp
        np.invert(d0, out=d0)
        np.bitwise_or(hn, d0, out=plus)
        np.minimum(best, score, out=best)
    return best


def _plausible(items: Items, windows: Iterator[tuple[np.ndarray, ...]], data: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    for window in windows:
        slack = np.floor(items.share * items.length[window[1]]).astype(np.int64)
        brief = np.flatnonzero(slack <= PIECE * 8)
        ok = np.concatenate([np.flatnonzero(slack > PIECE * 8), brief[plausible(items, data, window[1][brief], window[2][brief], slack[brief])]])
        yield tuple(x[ok] for x in window)


def _in_passes(windows: Iterator[tuple[np.ndarray, ...]]) -> Iterator[tuple[np.ndarray, ...]]:
    """The windows, so many at a time that numpy's calls pay."""
    some, n = [], 0
    for window in windows:
        some.append(window)
        n += len(window[0])
        if n >= PASS // 2:
            yield tuple(map(np.concatenate, zip(*some, strict=True)))
            some, n = [], 0
    if n:
        yield tuple(map(np.concatenate, zip(*some, strict=True)))


def find(items: Items, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Text number, item number, edits, and first byte (of the normal text) of the best place of each found item."""
    data, bounds, starts, ends, doc = normal(data, offsets)
    if not len(items.keys) or not len(starts):
        return []
    kept = [np.zeros((0, 3), np.int64)]
    for of, item, begin in _in_passes(_plausible(items, candidates(items, data, *window_begins(starts, ends, doc)), data)):
        slack = np.floor(items.share * items.length[item]).astype(np.int64)
        low, high = np.maximum(begin - slack, bounds[of]), np.minimum(begin + items.length[item] + slack, bounds[of + 1] - 1)
        # The bound first: it costs less than walks over whole windows, and rules out more.
        # Few windows are those of long items, and many steps: these are verified without a bound.
        brief = np.flatnonzero(slack <= PIECE * 8)
        kept_in = bounded(items, data, *(x[brief] for x in (item, begin, low, high, slack)))
        ok = np.concatenate([np.flatnonzero(slack > PIECE * 8), brief[kept_in]])
        of, item, begin = of[ok], item[ok], begin[ok]
        ok = agree(items, data, item, np.maximum(begin, bounds[of]), np.minimum(begin + items.length[item], bounds[of + 1] - 1))
        kept.append(np.column_stack([of, item, begin])[ok])
    of, item, begin = _distinct(*np.concatenate(kept).T)
    first, last, length = bounds[of], bounds[of + 1] - 1, items.length[item]
    slack = np.floor(items.share * length).astype(np.int64)
    low, high = np.maximum(begin - slack, first), np.minimum(begin + length + slack, last)
    best: dict[tuple[int, int], tuple[int, int]] = {}
    k = 0
    while k < len(of):
        # Windows of one item that overlap are verified in one go.
        to, m = high[k], k + 1
        while m < len(of) and of[m] == of[k] and item[m] == item[k] and low[m] <= to:
            to, m = max(to, high[m]), m + 1
        key = (int(of[k]), int(item[k]))
        if best.get(key, (1, 0))[0] > 0:
            text = data[low[k] : to].tobytes()
            edits, where = best_alignment(items.data[items.offsets[item[k]] : items.offsets[item[k] + 1]].tobytes(), text)
            place = int(low[k] - first[k]) + where
            if edits <= slack[k] and edits < best.get(key, (1 << 60, 0))[0]:
                best[key] = (edits, place)
        k = m
    return [(a, b, edits, place) for (a, b), (edits, place) in sorted(best.items())]


def _parts(benchmark: DataFrame, share: float) -> Iterator[Items]:
    """The items in parts of bounded size."""
    rows = benchmark.select("item_id", "text").where(F.length(F.trim("text")) > 0)
    count, size = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    parts = max(math.ceil(count / (ITEMS // 2)), math.ceil(size / (ITEM_BYTES // 2)), 1)
    for part in range(parts):
        chosen = rows if parts == 1 else rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)
        yield Items.of([(r["item_id"], r["text"]) for r in chosen.collect()], share)


def matches(documents: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """doc_id, item_id, edits, item_bytes and end_byte (in the normal text) of every item found in a document."""
    spark = configure(documents.sparkSession)
    out = None
    for items in _parts(benchmark, share):
        sent = spark.sparkContext.broadcast(items)  # at most ITEMS items

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            use = sent.value
            for batch, data, offsets in slices(batches):
                found = find(use, data, offsets)
                columns = [
                    batch.column(0).take(pa.array([f[0] for f in found], pa.int64())),
                    pa.array([use.ids[f[1]] for f in found], pa.int64()),
                    pa.array([f[2] for f in found], pa.int32()),
                    pa.array([int(use.length[f[1]]) for f in found], pa.int32()),
                    pa.array([f[3] for f in found], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "edits", "item_bytes", "end_byte"])

        found = documents.select("doc_id", "text").mapInArrow(run, "doc_id bigint, item_id bigint, edits int, item_bytes int, end_byte bigint")
        out = found if out is None else out.unionByName(found)
    return out


def without_matches(documents: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """The documents in which no item is found."""
    spark = configure(documents.sparkSession)
    for items in _parts(benchmark, share):
        sent = spark.sparkContext.broadcast(items)  # at most ITEMS items

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch, data, offsets in slices(batches):
                clean = np.ones(batch.num_rows, bool)
                clean[[f[0] for f in find(sent.value, data, offsets)]] = False
                yield batch.filter(pa.array(clean))

        documents = documents.mapInArrow(run, documents.schema)
    return documents
