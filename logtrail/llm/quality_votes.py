"""Quality by the votes of the nearest labelled texts in a latent-semantic space.

A text is its counts of terms: shapes of three neighbouring symbols (kinds of
letters, digits, blanks and signs), hashed words, words that repeat a recent
one, and how much of the text is repetition. Counts are damped, weighted by
inverse document frequency and projected on the leading singular vectors of a
labelled sample. The vectors of that sample are sent to every task; a block of
texts meets all of them in one matrix product, and the ``NEIGHBOURS`` nearest
by cosine vote with their similarity as weight.

The sample is bounded (``VOTERS`` texts of each label, of at most
``VOTER_CHARS`` characters), so the space and what is sent are too. Labels
that are null, or of texts that are not there, are left out. Null and empty
texts, and all texts where no label is known, score 0. Equal similarities are
ranked by the order of the sample, which is a hash of doc_id. Texts to be
scored are whole, and each is scored by itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from logtrail.llm.byte_text import hash_words, lower_ascii, slices, word_spans
from logtrail.llm.toxicity import training_sample
from logtrail.session import configure

VOTERS, VOTER_CHARS = 1500, 20_000
AXES, NEIGHBOURS = 48, 25
#: A score of at least this is good.
THRESHOLD = 0.3
#: Hashed words, and steps of the share of repeated words.
WORDS, SHARES, LAGS = 1024, 20, 4

_KIND = np.full(256, 13, np.int64)
_KIND[0x80:] = 0
for _kind, _symbols in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t", "\r\n", ".", ",", "|", "!?", "#$%&*@^~", "()[]{}<>", "'\"`", "-_=+/\\"), 1):
    for _symbol in _symbols:
        _KIND[ord(_symbol)] = _kind
_KIND[0x7F] = 15
_SHAPES = 16**3
TERMS = _SHAPES + WORDS + SHARES + LAGS


def terms(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts of each term, a row per text."""
    rows = len(offsets) - 1
    out = np.zeros((rows, TERMS), np.float32)
    doc = np.repeat(np.arange(rows), np.diff(offsets))
    if len(data) > 2:
        kind = _KIND[data]
        shape = (kind[:-2] * 16 + kind[1:-1]) * 16 + kind[2:]
        whole = doc[2:] == doc[:-2]
        out[:, :_SHAPES] = np.bincount((doc[:-2] * _SHAPES + shape)[whole], minlength=rows * _SHAPES).reshape(rows, _SHAPES)
    starts, ends, of = word_spans(data, offsets)
    if not len(starts):
        return out
    words = hash_words(lower_ascii(data), starts, ends)
    count = np.bincount(of, minlength=rows)
    out[:, _SHAPES : _SHAPES + WORDS] = np.bincount(of * WORDS + (words % np.uint64(WORDS)).astype(np.int64), minlength=rows * WORDS).reshape(rows, WORDS)
    order = np.lexsort((words, of))
    again = (words[order][1:] == words[order][:-1]) & (of[order][1:] == of[order][:-1])
    repeated = np.bincount(of[order][1:][again], minlength=rows)
    share = np.minimum((repeated * SHARES) // np.maximum(count, 1), SHARES - 1)
    out[np.arange(rows), _SHAPES + WORDS + share] = count
    for lag in range(1, LAGS + 1):
        if len(words) > lag:
            same = (words[lag:] == words[:-lag]) & (of[lag:] == of[:-lag])
            out[:, _SHAPES + WORDS + SHARES + lag - 1] = np.bincount(of[lag:][same], minlength=rows)
    return out


@dataclass(frozen=True)
class Voters:
    """Weights and axes of the space, and the labelled vectors of length one with their labels."""

    weights: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def place(self, counts: np.ndarray) -> np.ndarray:
        """Vectors of length one (0 for texts without terms)."""
        weighted = np.log1p(counts) * self.weights
        weighted /= np.maximum(np.linalg.norm(weighted, axis=1, keepdims=True), 1e-12)
        vectors = weighted @ self.axes
        return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Weighted vote of the nearest labelled texts for label 1."""
        rows = len(offsets) - 1
        out = np.zeros(rows)
        if not len(self.labels):
            return out
        k = min(NEIGHBOURS, len(self.labels))
        for begin in range(0, rows, 512):
            end = min(begin + 512, rows)
            part = self.place(terms(data[offsets[begin] : offsets[end]], offsets[begin : end + 1] - offsets[begin]))
            near = part @ self.vectors.T
            # Equal similarities in the order of the sample.
            best = np.argpartition(-near, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(near, best, 1), 0)
            total = weight.sum(1)
            out[begin:end] = np.where(total > 0, (weight * self.labels[best]).sum(1) / np.maximum(total, 1e-12), 0)
        return np.clip(out, 0, 1)


def fit(texts: list[tuple[str, int]], seed: int = 3) -> Voters:
    """The space and the voters from (text, label) pairs."""
    if not texts:
        return Voters(np.zeros(TERMS, np.float32), np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0, np.float32))
    raw = [t.encode() for t, _ in texts]
    counts = np.concatenate([terms(np.frombuffer(b"".join(raw[i : i + 64]), np.uint8), np.cumsum([0, *map(len, raw[i : i + 64])])) for i in range(0, len(raw), 64)])
    weights = (np.log((1 + len(raw)) / (1 + (counts > 0).sum(0))) + 1).astype(np.float32)
    x = np.log1p(counts) * weights
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    # Leading right singular vectors by subspace iteration.
    axes = np.random.default_rng(seed).standard_normal((TERMS, min(AXES + 16, len(raw)))).astype(np.float32)
    for _ in range(5):
        axes, _ = np.linalg.qr(x.T @ (x @ axes))
    small = x @ axes
    _, _, turn = np.linalg.svd(small, full_matrices=False)
    axes = (axes @ turn.T)[:, :AXES].astype(np.float32)
    space = Voters(weights, axes, np.zeros((0, 1), np.float32), np.zeros(0, np.float32))
    return Voters(weights, axes, space.place(counts).astype(np.float32), np.array([label for _, label in texts], np.float32))


def train(documents: DataFrame, labels: DataFrame, held_out=None) -> Voters:
    """Voters from the labelled documents outside the held-out fold."""
    configure(documents.sparkSession)
    return fit(training_sample(documents, labels, "quality", F.lit(False) if held_out is None else held_out, VOTERS, VOTER_CHARS))


def score(documents: DataFrame, voters: Voters, text: str = "text", into: str = "quality_score") -> DataFrame:
    """All columns, and the score of ``text``; a column of that name is replaced."""
    rows = documents.drop(into)
    sent = documents.sparkSession.sparkContext.broadcast(voters)  # 2 * VOTERS vectors at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in slices(batches, text):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sent.value.scores(data, offsets), pa.float64())], [*batch.schema.names, into])

    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField(into, DoubleType())]))
