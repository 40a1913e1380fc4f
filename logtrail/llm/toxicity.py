"""Toxicity by a support vector machine with a gappy subsequence kernel.

Two words are alike when they share subsequences of four symbols; each
occurrence weighs less the more symbols lie between. So an insult with
inserted characters, dropped ones or another ending stays close to the plain
one. As symbols inserted between all letters leave little of a word's kernel, a
word is also read without its digits and as its every second symbol, and its
worst reading counts. Landmark words (Nystroem's method) turn the kernel into a finite space,
in which a linear machine is trained on the words of labelled sentences. As
the machine is linear in the kernel, its landmarks fold into one weight per
subsequence of symbols, a table of fixed size, and a word is scored by its own
subsequences. A text is as toxic as its two worst words, mapped to 0..1 by a logistic
curve fitted on labelled texts.

Runs of three or more single letters between any blanks count as one word too, so
spelled-out insults are seen. Null and empty texts get the score of a text
without words, which is low. Labels that are null, or of texts that are not
there, are left out; without toxic and clean labels every score is 0. The
training sample is bounded by ``TRAIN_TEXTS`` and ``TRAIN_CHARS``; texts to be
scored are whole. Rows are scored one by one, so repeated rows score alike.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from logtrail.llm.byte_text import hash_words, lower_ascii, slices, word_spans
from logtrail.session import configure

#: Labelled texts of each kind used for training at most, and the longest of them in characters.
TRAIN_TEXTS, TRAIN_CHARS = 3000, 20_000
#: Weight per skipped symbol, and symbols from the first to the last of a subsequence: one may stand between any two.
DECAY, REACH = 0.6, 8
#: Added to the squared length of a word, so that words of few subsequences say less.
SHORT = 1.0
LANDMARKS, STEPS, ROUNDS = 400, 30, 4
#: Margins below this are all alike.
FLOOR = -0.5
#: Words whose margins a task remembers.
REMEMBERED = 1 << 18
#: A score of at least this is toxic.
THRESHOLD = 0.7

_SYMBOLS = 32
_SYMBOL = np.zeros(256, np.int32)
_SYMBOL[ord("a") : ord("z") + 1] = np.arange(1, 27)
_SYMBOL[ord("0") : ord("9") + 1] = 27
# The last byte of an accented letter stands for it; the first byte, and signs, are passed over.
_SYMBOL[0x80:0xC0] = 28 + np.arange(64) % 3
#: Stands before the first symbol of a word.
_BEGIN = _SYMBOLS - 1
_CODES = _SYMBOLS**4
_LETTER = (_SYMBOL > 0) & (_SYMBOL < 27)


def spelled(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of runs of three or more single letters with blanks between."""
    single = (ends - starts == 1) & _LETTER[data[starts]] if len(starts) else np.zeros(0, bool)
    linked = np.zeros(len(starts) + 1, bool)
    if len(starts) > 1:
        linked[1:-1] = single[1:] & single[:-1] & (doc[1:] == doc[:-1])
    first = np.flatnonzero(single & ~linked[:-1])
    last = np.flatnonzero(single & ~linked[1:])
    long = last - first >= 2
    return starts[first[long]], ends[last[long]], doc[first[long]]


def thinned(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What is left of words without inserted symbols: bytes, starts and ends, and the word of each.

    Words of letters and digits lose the digits; words of seven symbols or more are also read as their every
    second symbol, from the first and from the second one.
    """
    length = ends - starts
    before = np.concatenate([[0], np.cumsum(length)])
    source = np.repeat(starts - before[:-1], length) + np.arange(before[-1])
    word = np.repeat(np.arange(len(starts)), length)
    kept = _SYMBOL[data[source]] > 0
    source, word = source[kept], word[kept]
    symbols = np.bincount(word, minlength=len(starts))
    rank = np.arange(len(word)) - np.repeat(np.cumsum(symbols) - symbols, symbols)
    digit = _SYMBOL[data[source]] == 27
    digits = np.bincount(word[digit], minlength=len(starts))
    mixed = (digits > 0) & (symbols - digits >= 4)
    readings = [mixed[word] & ~digit, *((symbols[word] >= 7) & (rank % 2 == phase) for phase in (0, 1))]
    size = np.concatenate([np.bincount(word[chosen], minlength=len(starts)) for chosen in readings])
    used = np.flatnonzero(size)
    to = np.cumsum(size[used])
    return data[np.concatenate([source[chosen] for chosen in readings])], to - size[used], to, used % max(len(starts), 1)


def subsequences(symbols: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, Iterator[np.ndarray], float]]:
    """By the last offset: the positions whose word reaches that far, codes there for each choice of the others, and the weight.

    ``ends``: of the word at each position. Most positions are too close to their word's end for the far offsets.
    """
    at = np.arange(len(symbols))
    for c in range(3, REACH):
        at = at[ends[at] - at > c]
        yield at, _codes(symbols, at, c), DECAY ** (c - 3)


def _codes(symbols: np.ndarray, at: np.ndarray, c: int) -> Iterator[np.ndarray]:
    read = [symbols[at + k].astype(np.intp) for k in range(c + 1)]
    for b in range(2, c):
        later = read[b] * _SYMBOLS + read[c]
        for a in range(1, b):
            yield (read[0] * _SYMBOLS + read[a]) * _SYMBOLS**2 + later


def packed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of the given spans, each after a begin mark, where each begins, and the end for each position."""
    length = ends - starts + 1
    begin = np.concatenate([[0], np.cumsum(length)])
    source = np.repeat(starts - 1 - begin[:-1], length) + np.arange(begin[-1])
    symbols = _SYMBOL[data[np.maximum(source, 0)]]
    symbols[begin[:-1]] = _BEGIN
    kept = np.concatenate([[0], np.cumsum(symbols > 0)])
    symbols, begin = symbols[symbols > 0], kept[begin]
    return symbols, begin, np.repeat(begin[1:], np.diff(begin))


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values in order, a place of each, and the number of the value at each place."""
    order = np.argsort(values)
    held = values[order]
    new = np.append(True, held[1:] != held[:-1])[: len(held)]
    number = np.empty(len(values), np.intp)
    number[order] = np.cumsum(new) - 1
    return held[new], order[new], number


class Memory:
    """Margins of words that a task has met, by the words' hashes: most words of a text are in others too.

    With more than ``REMEMBERED`` words, only those met last stay.
    """

    def __init__(self) -> None:
        self.keys, self.margins = np.zeros(0, np.uint64), np.zeros(0, np.float32)

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each key is or belongs, and whether it is there."""
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == keys[inside]
        return at, known

    def add(self, at: np.ndarray, known: np.ndarray, keys: np.ndarray, margins: np.ndarray) -> None:
        """Take in the keys that were not known; ``keys`` and ``margins`` are all that were asked for."""
        if len(self.keys) + np.count_nonzero(~known) > REMEMBERED:
            self.keys, self.margins = keys, margins
        else:
            self.keys, self.margins = np.insert(self.keys, at[~known], keys[~known]), np.insert(self.margins, at[~known], margins[~known])


@dataclass(frozen=True)
class Model:
    """A weight per subsequence, the machine's bias, and the logistic curve over a text's worst words."""

    weights: np.ndarray
    bias: float
    slope: float
    middle: float

    def words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Margin of each span."""
        symbols, begin, end_at = packed(data, starts, ends)
        value, norm = np.zeros(len(symbols), np.float32), np.zeros(len(symbols), np.float32)
        for at, codes, weight in subsequences(symbols, end_at):
            weight, sums, squares = np.float32(weight), value[at], norm[at]
            for code in codes:
                sums += weight * self.weights.take(code, mode="clip")
                squares += weight * weight
            value[at], norm[at] = sums, squares
        if not len(starts):
            return np.zeros(0)
        value, norm = np.add.reduceat(value, begin[:-1]), np.add.reduceat(norm, begin[:-1])
        margin = value / np.sqrt(norm + SHORT) - self.bias
        # A subsequence that occurs again in its word makes the norm larger than that sum: made up for where it matters.
        again = np.flatnonzero(margin > FLOOR)
        if len(again):
            codes, at, weights = _merged(*packed(data, starts[again], ends[again]))
            margin[again] = value[again] / np.sqrt(np.bincount(at, weights**2, len(again)) + SHORT) - self.bias
        return margin

    def margins(self, data: np.ndarray, offsets: np.ndarray, memory: Memory | None = None) -> np.ndarray:
        """Largest word margin of each text, and the second to a quarter; each within FLOOR and 1."""
        data = lower_ascii(data)
        starts, ends, doc = word_spans(data, offsets)
        more = spelled(data, starts, ends, doc)
        starts, ends, doc = (np.concatenate(pair) for pair in zip((starts, ends, doc), more, strict=True))
        best = np.full((2, len(offsets) - 1), FLOOR)
        if len(starts):
            keys, first, inverse = _distinct(hash_words(data, starts, ends))
            at, known = memory.places(keys) if memory else (keys, np.zeros(len(keys), bool))
            new = first[~known]
            fresh = self.words(data, starts[new], ends[new])
            less, begin, end, word = thinned(data, starts[new], ends[new])
            if len(word):
                np.maximum.at(fresh, word, self.words(less, begin, end))
            margin = np.empty(len(keys), np.float32)
            margin[~known] = fresh
            if memory:
                margin[known] = memory.margins[at[known]]
                memory.add(at, known, keys, margin)
            margin = np.minimum(margin, 1.0)[inverse]
            some = np.flatnonzero(margin > FLOOR)
            some = some[np.lexsort((margin[some], doc[some]))]
            doc, margin = doc[some], margin[some]
            for k in (0, 1):
                # The last of each text is its largest; the one before it the second.
                last = np.flatnonzero(np.append(doc[1:] != doc[:-1], True)) if len(doc) else np.zeros(0, int)
                best[k, doc[last]] = margin[last]
                doc, margin = np.delete(doc, last), np.delete(margin, last)
        return 0.75 * best[0] + 0.25 * best[1]

    def scores(self, data: np.ndarray, offsets: np.ndarray, memory: Memory | None = None) -> np.ndarray:
        return 1 / (1 + np.exp(-self.slope * (self.margins(data, offsets, memory) - self.middle)))


def _entries(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Subsequences of all words, the number of the word of each, and the weight; each word is of about unit length."""
    raw = [w.encode() for w in words]
    ends = np.cumsum([len(r) for r in raw])
    starts = ends - np.array([len(r) for r in raw])
    codes, at, weights = _merged(*packed(np.frombuffer(b"".join(raw), np.uint8), starts, ends))
    norm = np.sqrt(np.bincount(at, weights**2, len(words)) + SHORT)
    return codes, at, weights / norm[at]


def _merged(symbols: np.ndarray, begin: np.ndarray, end_at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each subsequence of each word once, the number of its word, and its weight over all occurrences."""
    word = np.repeat(np.arange(len(begin) - 1, dtype=np.int64), np.diff(begin))
    found = [(word[at] * _CODES + code, np.full(len(at), weight)) for at, codes, weight in subsequences(symbols, end_at) for code in codes]
    keys, weights = (np.concatenate(part) for part in zip(*found, strict=True))
    keys, inverse = np.unique(keys, return_inverse=True)
    return keys % _CODES, keys // _CODES, np.bincount(inverse, weights, len(keys))


class Landmarks:
    """The finite space that some words span: kernel with them, whitened."""

    def __init__(self, words: list[str]):
        codes, at, weights = _entries(words)
        self._used = np.unique(codes)
        self._table = np.zeros((len(self._used) + 1, len(words)), np.float32)
        np.add.at(self._table, (np.searchsorted(self._used, codes), at), weights)
        values, axes = np.linalg.eigh(self.kernel(words).astype(float))
        kept = values > values.max() * 1e-3
        self._whiten = axes[:, kept] / np.sqrt(values[kept])

    def kernel(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), self._table.shape[1]), np.float32)
        for begin in range(0, len(words), 128):
            codes, at, weights = _entries(words[begin : begin + 128])
            row = np.minimum(np.searchsorted(self._used, codes), len(self._used) - 1)
            hit = np.flatnonzero(self._used[row] == codes)
            hit = hit[np.argsort(at[hit], kind="stable")]
            if len(hit):
                word, first = np.unique(at[hit], return_index=True)
                out[begin + word] = np.add.reduceat(weights[hit, None].astype(np.float32) * self._table[row[hit]], first, 0)
        return out

    def features(self, words: list[str]) -> np.ndarray:
        return self.kernel(words) @ self._whiten

    def code_weights(self, beta: np.ndarray) -> np.ndarray:
        """The machine as a weight per subsequence."""
        weights = np.zeros(_CODES)
        weights[self._used] = self._table[:-1] @ (self._whiten @ beta)
        return weights


def _flat() -> Model:
    """Nothing is toxic."""
    return Model(np.zeros(_CODES, np.float32), 0.0, 1.0, 50.0)


_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text: str) -> list[str]:
    """Lower-cased words of a text."""
    return _TOKEN.findall(text.translate(_ASCII_LOWER))


_ASCII_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def telling_parts(toxic: Counter[str], clean: Counter[str], least: int, sizes: tuple[int, ...] = (4, 5, 6, 7)) -> list[str]:
    """Parts of words of toxic texts that hardly occur in clean ones, most frequent first.

    The counts say in how many places a word was seen. A part is taken for what it
    explains: words that hold an earlier part no longer count for it.
    """

    def parts(word: str, n: int) -> set[str]:
        return {word[i : i + n] for i in range(len(word) - n + 1)}

    found: set[str] = set()
    for size in sizes:  # one size at a time, for memory
        in_toxic: Counter[str] = Counter()
        for word, n in toxic.items():
            for part in parts(word, size):
                in_toxic[part] += n
        often = {p: n for p, n in in_toxic.items() if n >= least}
        del in_toxic
        in_clean = dict.fromkeys(often, 0)
        for word, n in clean.items():
            for part in parts(word, size) & often.keys():
                in_clean[part] += n
        found |= {p for p, n in often.items() if in_clean[p] * 100 <= n}
    holders: dict[str, set[str]] = {}
    for word in toxic:
        for part in {p for size in sizes for p in parts(word, size)} & found:
            holders.setdefault(part, set()).add(word)
    chosen: list[str] = []
    while holders:
        # The longer part of nearly equally good ones is the more telling.
        size = {p: sum(toxic[w] for w in words) for p, words in holders.items()}
        most = max(size.values())
        if most < least:
            break
        best = max((p for p in holders if size[p] >= 0.95 * most), key=lambda p: (len(p), size[p], p))
        chosen.append(best)
        gone = holders.pop(best)
        holders = {p: rest for p, words in holders.items() if (rest := words - gone)}
    return chosen


def fit(texts: list[tuple[str, int]], seed: int = 7) -> Model:
    """Train on (text, label) pairs; a null or other label must not be among them."""
    if len({label for _, label in texts}) < 2:
        return _flat()
    clean_words = Counter(w for text, label in texts if label == 0 for w in set(tokens(text)))
    # A word of toxic texts counts once per word before it: copies of one text add nothing.
    pairs = {pair for text, label in texts if label == 1 for pair in pairwise(["", *tokens(text)]) if pair[1] not in clean_words}
    toxic_words = Counter(w for _, w in pairs)
    del pairs
    parts = telling_parts(toxic_words, clean_words, max(3, len(texts) // 250))
    if not parts:
        return _flat()
    wanted = {w: n for w, n in toxic_words.items() if w not in clean_words and any(p in w for p in parts)}
    rng = np.random.default_rng(seed)
    positive = sorted(wanted, key=lambda w: (-wanted[w], w))
    order = sorted(clean_words)
    # Negatives: the commonest clean words, those near the telling parts, and others at random.
    pieces = {p[i : i + 3] for p in parts for i in range(len(p) - 2)}
    near = [w for w in order if sum(w[i : i + 3] in pieces for i in range(len(w) - 2)) >= 2]
    common = [w for w, _ in sorted(clean_words.items(), key=lambda x: (-x[1], x[0]))[:3000]]
    negative = sorted({*common, *(near[i] for i in rng.permutation(len(near))[:4000]), *(order[i] for i in rng.permutation(len(order))[:3000])})
    # Landmarks: for each telling part its commonest words in turn, so that each part has some; then clean words.
    by_part = [[w for w in positive if p in w] for p in parts]
    landmarks: list[str] = []
    for turn in range(LANDMARKS):
        landmarks += [words[turn] for words in by_part if turn < len(words) and len(landmarks) < LANDMARKS // 2]
    landmarks = list(dict.fromkeys([*landmarks, *common[: LANDMARKS // 4], *(near[i] for i in rng.permutation(len(near))[: LANDMARKS // 4])]))
    chosen = positive[:3000]
    # Each telling part counts alike, however many words hold it.
    part_of = [next(p for p in parts if p in w) for w in chosen]
    size = Counter(part_of)
    toxic_weight = np.array([max(1.0, 100 / size[p]) for p in part_of])
    raw = [w.encode() for w in order]
    ends = np.cumsum([len(w) for w in raw])
    starts, data = ends - np.array([len(w) for w in raw]), np.frombuffer(b"".join(raw), np.uint8)
    model, held = _flat(), set(negative)
    for _ in range(ROUNDS):
        space = Landmarks(landmarks)
        x = space.features([*chosen, *negative])
        y = np.concatenate([np.ones(len(chosen)), -np.ones(len(negative))])
        beta, bias = _machine(x, y, np.concatenate([toxic_weight, np.sqrt([clean_words[w] for w in negative])]))
        model = Model(space.code_weights(beta).astype(np.float32), -bias, 1.0, 0.0)
        # The clean words that the machine takes for toxic join the next round, the worst as landmarks.
        margin = np.concatenate([model.words(data, starts[i : i + 20000], ends[i : i + 20000]) for i in range(0, len(raw), 20000)])
        worst = [order[i] for i in np.argsort(-margin)[:2000] if margin[i] > -0.7]
        landmarks = list(dict.fromkeys([*landmarks, *worst[: LANDMARKS // 4]]))
        worst = [w for w in worst if w not in held]
        if not worst:
            break
        negative += worst
        held.update(worst)
    return _with_curve(model, texts)


def _machine(x: np.ndarray, y: np.ndarray, weight: np.ndarray, strength: float = 1.0) -> tuple[np.ndarray, float]:
    """Linear support vector machine with squared hinge loss, by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], strength)
    ridge[-1] = strength / 100
    for _ in range(STEPS):
        inside = y * (x @ w) < 1
        part, c = x[inside], weight[inside]
        new = np.linalg.solve(part.T @ (part * c[:, None]) + np.diag(ridge), part.T @ (c * y[inside]))
        if np.allclose(new, w, atol=1e-6):
            break
        w = w + 0.7 * (new - w)
    return w[:-1], float(w[-1])


def _with_curve(model: Model, texts: list[tuple[str, int]]) -> Model:
    """Fit the logistic curve on the texts' margins, with equal weight of both kinds."""
    raw = [t.encode() for t, _ in texts]
    margin = np.concatenate([model.margins(np.frombuffer(t, np.uint8), np.array([0, len(t)])) for t in raw])
    label = np.array([v for _, v in texts])
    weight = np.where(label == 1, 0.5 / max((label == 1).sum(), 1), 0.5 / max((label == 0).sum(), 1))
    best = (np.inf, 1.0, 0.0)
    # Midpoints and slopes on a grid: the loss has two parameters only.
    for middle in np.linspace(FLOOR, 1, 61):
        for slope in (1, 2, 4, 8):
            p = 1 / (1 + np.exp(-np.clip(slope * (margin - middle), -30, 30)))
            loss = -(weight * np.where(label == 1, np.log(p + 1e-9), np.log(1 - p + 1e-9))).sum()
            best = min(best, (float(loss), float(slope), float(middle)))
    return Model(model.weights, model.bias, best[1], best[2])


def training_sample(documents: DataFrame, labels: DataFrame, label: str, held_out, texts: int = TRAIN_TEXTS, chars: int = TRAIN_CHARS) -> list[tuple[str, int]]:
    """At most ``texts`` texts of each kind, chosen by a hash of their number."""
    known = labels.where(~held_out).where(F.col(label).isin(0, 1)).select("doc_id", F.col(label).cast("int").alias("_label"))
    chosen = None
    for kind in (0, 1):
        some = known.where(F.col("_label") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(texts)
        chosen = some if chosen is None else chosen.unionByName(some)
    rows = documents.select("doc_id", "text").where(F.length("text") <= chars)
    # At most 2 * texts rows of two numbers: a bounded broadcast.
    joined = rows.join(F.broadcast(chosen.dropDuplicates(["doc_id"])), "doc_id").select("doc_id", "text", "_label")
    found = joined.orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(2 * texts).collect()
    return [(r["text"], r["_label"]) for r in found]


def fold(divisor: int, remainder: int, doc_id: str = "doc_id"):
    """Whether the checksum of the number as text leaves a remainder; a null number counts as held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(divisor)) == remainder, F.lit(True))


def train(documents: DataFrame, labels: DataFrame, held_out=None) -> Model:
    """A model from the labelled documents outside the held-out fold."""
    configure(documents.sparkSession)
    return fit(training_sample(documents, labels, "toxic", F.lit(False) if held_out is None else held_out))


def score(documents: DataFrame, model: Model, text: str = "text", into: str = "toxicity") -> DataFrame:
    """All columns, and the score of ``text``; a column of that name is replaced."""
    rows = documents.drop(into)
    sent = documents.sparkSession.sparkContext.broadcast(model)  # one table of 32**4 weights, whatever the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use, memory = sent.value, Memory()
        for batch, data, offsets in slices(batches, text):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(use.scores(data, offsets, memory), pa.float64())], [*batch.schema.names, into])

    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField(into, DoubleType())]))
