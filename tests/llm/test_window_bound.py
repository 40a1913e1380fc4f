"""The bound by strings of three bytes: it rules out most windows and none that is within the share."""

import random

import numpy as np

from logtrail.llm import decontaminate


def made(rng, pool, n):
    return " ".join(rng.choice(pool) for _ in range(n))


def test_few_windows_reach_the_bound_of_pieces_and_none_is_lost(monkeypatch):
    rng = random.Random(3)
    pool = ["".join(rng.choice("eeeeaaiotnshrdlu") for _ in range(rng.randint(2, 7))) for _ in range(800)]
    items = [made(rng, pool, 18) for _ in range(40)]
    texts = []
    for k in range(120):
        planted = list(items[k % 40])
        for _ in range(k % 7 * len(planted) // 40):
            planted[rng.randrange(len(planted))] = rng.choice("abcdeilnorst")
        texts.append(f"{made(rng, pool, 300)} {''.join(planted) if k % 2 else ''} {made(rng, pool, 300)}".encode())
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    use = decontaminate.Items.of(list(enumerate(items)))
    seen, bounded = [], decontaminate.bounded

    def counted(items, data, item, *rest):
        seen.append(len(item))
        return bounded(items, data, item, *rest)

    monkeypatch.setattr(decontaminate, "bounded", counted)
    found, few = decontaminate.find(use, data, offsets), sum(seen)
    # So many windows that no item has as many: all are left to the pieces.
    monkeypatch.setattr(decontaminate, "GROUP", 1 << 40)
    seen.clear()
    assert decontaminate.find(use, data, offsets) == found
    assert len({f[:2] for f in found}) >= 40
    assert few < sum(seen) / 2


def test_a_window_with_as_many_edits_as_are_allowed_is_kept():
    rng = np.random.default_rng(5)
    for size in (1, 2, 3, 5, 16, 81, 150, 394):
        item = bytes(rng.integers(97, 123, size).astype(np.uint8))
        use = decontaminate.Items.of([(0, item.decode())])
        edits = int(decontaminate.SHARE * size)
        for place in rng.choice(size, edits, replace=False) if edits else [0]:
            item = item[:place] + (b"#" if edits else item[place : place + 1]) + item[place + 1 :]
        text = np.frombuffer(b"x" * 70 + item + b"y" * 70, np.uint8)
        begin = np.full(decontaminate.GROUP, 70)
        kept = decontaminate.plausible(use, text, np.zeros(len(begin), np.int64), begin, np.full(len(begin), edits))
        assert len(kept) == len(begin)
