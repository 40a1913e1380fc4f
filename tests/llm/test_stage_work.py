"""Work that the pipeline's stages leave out or do at once: subsequences, windows that hold too little of an item, order of n-grams, ids of pieces."""

import random

import numpy as np

from logtrail.llm import byte_bpe, byte_text, decontaminate, jaccard_rtree, toxicity
from logtrail.llm.queries import bpe_files


def words_of(rng, count):
    return ["".join(rng.choice("abcdeilnorst5é") for _ in range(rng.randint(1, 14))) for _ in range(count)]


def packed_words(words):
    raw = [w.encode() for w in words]
    ends = np.cumsum([len(r) for r in raw])
    starts = ends - np.array([len(r) for r in raw])
    return np.frombuffer(b"".join(raw), np.uint8), starts, ends


def test_only_subsequences_within_a_word_are_read():
    data, starts, ends = packed_words(words_of(random.Random(2), 300))
    symbols, begin, end_at = toxicity.packed(data, starts, ends)
    expected = []
    for first, last in zip(begin[:-1], begin[1:], strict=True):
        for at in range(first, last):
            for c in range(3, toxicity.REACH):
                if at + c < last:
                    for b in range(2, c):
                        for a in range(1, b):
                            code = 0
                            for k in (0, a, b, c):
                                code = code * 32 + int(symbols[at + k])
                            expected.append((at, code, toxicity.DECAY ** (c - 3)))
    found = [(int(p), int(code), weight) for at, codes, weight in toxicity.subsequences(symbols, end_at) for row in codes for p, code in zip(at, row, strict=True)]
    assert sorted(found) == sorted(expected)
    assert len(found) < 0.5 * 35 * len(symbols)


def test_margins_are_sums_over_all_subsequences():
    rng = np.random.default_rng(3)
    model = toxicity.Model(rng.normal(0, 0.1, 32**4).astype(np.float32), 0.9, 1.0, 0.0)
    data, starts, ends = packed_words([*words_of(random.Random(4), 200), "a", "ab"])
    symbols, begin, end_at = toxicity.packed(data, starts, ends)
    value, norm = np.zeros(len(begin) - 1), np.zeros(len(begin) - 1)
    word = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
    for at, codes, weight in toxicity.subsequences(symbols, end_at):
        for code in codes:
            np.add.at(value, word[at], weight * model.weights[code])
            np.add.at(norm, word[at], weight**2)
    plain = value / np.sqrt(norm + toxicity.SHORT) - model.bias
    got, low = model.words(data, starts, ends), plain <= toxicity.FLOOR - 1e-3
    assert low.any()
    np.testing.assert_allclose(got[low], plain[low], rtol=1e-4, atol=1e-5)
    assert len(toxicity.Model(model.weights, 0.0, 1.0, 0.0).words(data, starts[:0], ends[:0])) == 0


def test_items_with_few_windows_have_the_cheap_bound_too(monkeypatch):
    rng = random.Random(3)
    pool = ["".join(rng.choice("eeeeaaiotnshrdlu") for _ in range(rng.randint(2, 7))) for _ in range(800)]
    made = lambda n: " ".join(rng.choice(pool) for _ in range(n))
    items = [made(28) for _ in range(400)]
    texts = [f"{made(20)} {items[k] if k % 2 == 0 else ''} {made(20)}".encode() for k in range(2)]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    use = decontaminate.Items.of(list(enumerate(items)))
    before, after = [], []
    plausible, bounded = decontaminate.plausible, decontaminate.bounded
    monkeypatch.setattr(decontaminate, "plausible", lambda *a: (before.append(a[2]), plausible(*a))[1])
    monkeypatch.setattr(decontaminate, "bounded", lambda *a: (after.append(a[2]), bounded(*a))[1])
    found = {f[:2] for f in decontaminate.find(use, data, offsets)}
    assert (0, 0) in found
    windows = np.concatenate(before)
    assert np.bincount(windows).max() < 16 <= len(windows)
    assert sum(map(len, after)) < len(windows) / 2


def test_order_within_texts():
    rng = np.random.default_rng(6)
    for texts in (1, 7, 70_000):
        of = np.concatenate([np.sort(rng.integers(0, texts, 400)), rng.integers(0, texts, 30), [texts - 1]])
        values = rng.integers(0, 1 << 63, len(of)).astype(np.uint64) << np.uint64(1)
        values[:200] = values[200:400]
        order = jaccard_rtree.within_texts(values, of, texts)
        expected = np.lexsort((values, of))
        assert np.array_equal(values[order], values[expected]) and np.array_equal(of[order], of[expected])
    assert len(jaccard_rtree.within_texts(np.zeros(0, np.uint64), np.zeros(0, np.int64), 0)) == 0


def test_ids_of_many_pieces_come_as_one_array():
    use = byte_bpe.Encoder(*bpe_files())
    rng = random.Random(8)
    pieces = [w.encode() for w in words_of(rng, 400)] + [b"ab" * 200, b"z" * 300, b"\x00", "ñ€".encode(), b"ab" * 200]

    def alone(piece):
        ids = use._bytes[np.frombuffer(piece, np.uint8)].tolist()
        while len(ids) > 1:
            found = use._pairs.find(np.array(ids[:-1]), np.array(ids[1:]))
            if (found < 0).all():
                break
            best = found[found >= 0].min()
            at = int(np.flatnonzero(found == best)[0])
            ids[at : at + 2] = [int(best)]
        return ids

    flat, offsets = use.merge_rows(pieces)
    assert [flat[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)] == [alone(p) for p in pieces]
    ids = dict(use._encode_pieces([b"", *pieces, b"q" * 999]))
    assert [list(ids[k]) for k in range(len(pieces) + 2)] == [[], *map(alone, pieces), alone(b"q" * 999)]
    text = b" ".join(pieces).decode()
    assert use.decode(use.encode([text])[0]) == text.encode()
    assert dict(use._encode_pieces([])) == {}


def test_words_that_were_met_are_not_scored_again(monkeypatch):
    rng = np.random.default_rng(9)
    model = toxicity.Model(rng.normal(0, 0.3, 32**4).astype(np.float32), 0.1, 2.0, 0.2)
    words = words_of(random.Random(10), 500)
    texts = [" ".join(words[k * 40 : k * 40 + 120]).encode() for k in range(10)] + [b"", b"a b c 5 x1y2z3w4", *[" ".join(words).encode()] * 2]
    plain = [model.scores(np.frombuffer(t, np.uint8), np.array([0, len(t)])) for t in texts]
    for most in (toxicity.REMEMBERED, 150, 0):
        monkeypatch.setattr(toxicity, "REMEMBERED", most)
        seen, scored = [], toxicity.Model.words
        monkeypatch.setattr(toxicity.Model, "words", lambda self, data, starts, ends: (seen.append(len(starts)), scored(self, data, starts, ends))[1])
        memory = toxicity.Memory()
        kept = [model.scores(np.frombuffer(t, np.uint8), np.array([0, len(t)]), memory) for t in texts]
        monkeypatch.setattr(toxicity.Model, "words", scored)
        assert [k.tolist() for k in kept] == [p.tolist() for p in plain]
        if most > 500:
            # The last text has no word that is new.
            assert seen[-1] == 0 < seen[0]


def test_words_are_found_as_by_looking_up_every_byte():
    rng = np.random.default_rng(11)
    blank = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
    for size in (0, 1, 2, 300, 3000):
        data = rng.choice(np.array([0x08, 0x09, 0x0D, 0x0E, 0x20, 0x40, 0x41, 0x5A, 0x5B, 0x61, 0xC3, 0xFF], np.uint8), size)
        offsets = np.sort(np.concatenate([[0, 0, size, size], rng.integers(0, size + 1, 5)]))
        starts, ends, doc = byte_text.word_spans(data, offsets)
        expected = []
        for k, (first, last) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
            at = first
            while at < last:
                to = at
                while to < last and not blank[data[to]]:
                    to += 1
                if to > at:
                    expected.append((at, to, k))
                at = to + 1
        assert list(zip(starts, ends, doc, strict=True)) == expected
        assert byte_text.word_bytes(data).tobytes() == b"".join(data[a:b].tobytes() for a, b, _ in expected)
        assert byte_text.lower_ascii(data).tobytes() == data.tobytes().lower()
