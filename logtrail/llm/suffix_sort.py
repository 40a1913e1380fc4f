"""Suffix arrays by induced sorting, and permuted common prefixes, over numpy arrays.

The sequential scans of induced sorting run bucket by bucket here: all entries
of a bucket induce their left neighbours in one step, and those that fall into
the same bucket form the next step. The order is that of the scan.
"""

from __future__ import annotations

import numpy as np


def smaller_types(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one; the end counts as smallest."""
    n = len(text)
    out = np.zeros(n, bool)
    if n < 2:
        return out
    sign = np.zeros(n, np.int8)
    sign[:-1] = np.sign(text[1:].astype(np.int64) - text[:-1].astype(np.int64))
    sign[-1] = -1
    # A run of equal symbols has the type of its last one.
    known = np.where(sign != 0, np.arange(n), n)
    known = np.minimum.accumulate(known[::-1])[::-1]
    return sign[known] > 0


class _Buckets:
    def __init__(self, text: np.ndarray, symbols: int):
        self.text, self.smaller = text, smaller_types(text)
        count = np.bincount(text, minlength=symbols)
        self.ends = np.cumsum(count)
        self.starts = self.ends - count
        self.symbols = np.flatnonzero(count)


def _append(array: np.ndarray, slots: np.ndarray, values: np.ndarray, symbols: np.ndarray, step: int) -> None:
    """Put values into their symbols' buckets in order, at the next free slot upwards or downwards."""
    order = np.argsort(symbols, kind="stable")
    symbols, values = symbols[order], values[order]
    first = np.flatnonzero(np.concatenate([[True], symbols[1:] != symbols[:-1]]))
    count = np.diff(np.append(first, len(symbols)))
    rank = np.arange(len(symbols)) - np.repeat(first, count)
    array[slots[symbols] + step * rank] = values
    slots[symbols[first]] += step * count


def _induce(b: _Buckets, sorted_left: np.ndarray) -> np.ndarray:
    """All suffixes in order, given the leftmost smaller ones in order."""
    text, smaller, n = b.text, b.smaller, len(b.text)
    array = np.full(n, -1, np.int64)
    tails = b.ends - 1
    placed = sorted_left[::-1]
    if len(placed):
        _append(array, tails, placed, text[placed], -1)
    heads = b.starts.copy()
    _append(array, heads, np.array([n - 1]), text[n - 1 :], 1)

    def left_of(entries: np.ndarray, want_smaller: bool) -> np.ndarray:
        before = entries - 1
        before = before[before >= 0]
        return before[smaller[before] == want_smaller]

    for c in b.symbols:
        done = b.starts[c]
        while done < heads[c]:
            now, done = array[done : heads[c]], heads[c]
            before = left_of(now, False)
            if len(before):
                _append(array, heads, before, text[before], 1)
        rest = array[tails[c] + 1 : b.ends[c]]
        if len(rest):
            before = left_of(rest, False)
            if len(before):
                _append(array, heads, before, text[before], 1)
    tails = b.ends - 1
    for c in b.symbols[::-1]:
        done = b.ends[c] - 1
        while done > tails[c]:
            now, done = array[tails[c] + 1 : done + 1][::-1], tails[c]
            before = left_of(now, True)
            if len(before):
                _append(array, tails, before, text[before], -1)
        larger = array[b.starts[c] : heads[c]][::-1]
        if len(larger):
            before = left_of(larger, True)
            if len(before):
                _append(array, tails, before, text[before], -1)
    return array


def _names(text: np.ndarray, left: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Rank of the substring from each leftmost smaller suffix to the next; equal ones share it."""
    n = len(text)
    number = np.full(n, -1, np.int64)
    number[left] = np.arange(len(left))
    end = np.append(left[1:] + 1, n)
    at = number[ordered]
    length = end[at] - left[at]
    same = np.concatenate([[False], length[1:] == length[:-1]])
    # The last one runs into the end of the text, which no other does.
    same &= (at != len(left) - 1) & (np.concatenate([[0], at[:-1]]) != len(left) - 1)
    check = np.flatnonzero(same)
    if len(check):
        size = length[check]
        first = np.cumsum(size) - size
        step = np.arange(size.sum()) - np.repeat(first, size)
        equal = text[np.repeat(ordered[check], size) + step] == text[np.repeat(ordered[check - 1], size) + step]
        same[check] = np.logical_and.reduceat(equal, first)
    names = np.empty(len(left), np.int64)
    names[at] = np.cumsum(~same) - 1
    return names


def _by_doubling(names: np.ndarray) -> np.ndarray:
    """Suffix array of a text over many symbols: ranks of twice the length in each round.

    Used below the top level: there a bucket has a few entries only, and a step per bucket would cost more.
    """
    rank, step, n = names, 1, len(names)
    while True:
        second = np.zeros(n, np.int64)
        second[: max(n - step, 0)] = rank[step:] + 1
        key = rank * (n + 1) + second
        order = np.argsort(key, kind="stable")
        new = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = new
        if new[-1] == n - 1:
            return order
        step *= 2


def suffix_array(text: np.ndarray, symbols: int) -> np.ndarray:
    """Begins of the suffixes of a text of small whole numbers, in order."""
    if len(text) < 2:
        return np.arange(len(text))
    b = _Buckets(text, symbols)
    left = np.flatnonzero(b.smaller[1:] & ~b.smaller[:-1]) + 1
    if not len(left):
        return _induce(b, left)
    is_left = np.zeros(len(text), bool)
    is_left[left] = True
    array = _induce(b, left)
    names = _names(text, left, array[is_left[array]])
    if names.max() == len(left) - 1:
        order = np.empty(len(left), np.int64)
        order[names] = np.arange(len(left))
    elif names.max() < 256 and len(left) > 256:
        order = suffix_array(names, int(names.max()) + 1)
    else:
        order = _by_doubling(names)
    return _induce(b, left[order])


def common_prefixes(text: np.ndarray, array: np.ndarray, cap: int, anew: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """For each position the suffix before it in order (-1 for the first) and the length both share.

    Only where the symbols before two neighbours differ is a prefix compared;
    elsewhere it is one shorter than at the position before. Compared lengths
    stop at ``cap``, so a length is right as far as it is at most ``cap`` less
    the distance from the last compared position; ``anew``: positions to compare in any case.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[array[1:]] = array[:-1]
    shifted = before - 1
    reducible = np.zeros(n, bool)
    reducible[1:] = (before[1:] > 0) & (before[:-1] == shifted[1:]) & (text[:-1] == text[np.maximum(shifted[1:], 0)])
    if anew is not None:
        reducible[anew] = False
    start = np.flatnonzero(~reducible & (before >= 0))
    other = before[start]
    padded = np.concatenate([text, np.full(cap + 8, -1, text.dtype)])
    length = np.zeros(len(start), np.int64)
    active = np.arange(len(start))
    step = 8
    grid = np.arange(step)
    while len(active):
        a, c = start[active] + length[active], other[active] + length[active]
        # Behind the end the longer suffix always differs.
        equal = (padded[a[:, None] + grid] == padded[c[:, None] + grid]) & (a[:, None] + grid < n) & (c[:, None] + grid < n)
        run = np.where(equal.all(1), step, equal.argmin(1))
        length[active] += run
        active = active[(run == step) & (length[active] < cap)]
    out = np.zeros(n, np.int64)
    out[start] = length
    last = np.maximum.accumulate(np.where(reducible, -1, np.arange(n)))
    inside = np.flatnonzero(reducible)
    out[inside] = np.maximum(out[last[inside]] - (inside - last[inside]), 0)
    return before, out
