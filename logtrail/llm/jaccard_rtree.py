"""Joins documents whose sets of word n-grams have a high Jaccard similarity.

Candidates come from count vectors. Every n-gram hashes to a group, and a
document is the point of its counts per group. For two linked documents of
sizes x and y at most D = (x + y) (1 - t) / (1 + t) n-grams are not shared, so
their points lie within D of each other. Two uses are made of that:

* Routing. If the groups are cut into more than D blocks, one block is the
  same in both. Documents of like size (size classes with a ratio of 1.5, the
  upper tenth of a class goes with the next class as well) therefore meet
  under the key of at least one block. Documents that share a block of a few
  n-grams form a family, found as connected components. Blocks of less are
  too common for that; documents that meet under such a key, and not in a
  family, are compared under that key by their points alone, and the few pairs
  that are left on their sets.
* R-tree. Members of a family that link with the one it is named by are its
  core, and so are members of a key that are of its largest family: they are
  connected, and only compared with the others. The members are the points of a
  tree whose first level is size (only neighbouring size bands can link), whose
  second level are leaves of at most about ``LEAF`` points, and whose third level are boxes
  of ``BOX`` points, sorted by their coordinates. A pair of boxes, then a pair
  of points, is left out when the sum over groups of the smaller count cannot
  reach the overlap that a link needs. A pair of leaves is one unit of work,
  so a family that holds a third of all documents is spread over many tasks.

Pairs that survive are verified on their whole sets, unless they are connected
already. Whole sets are long, so finer points, of about a coordinate per ``FINE``
n-grams, are compared ahead of their shuffle, and most sets stay where they are. Documents with equal sets are one point from the start. Before all that, a
document is left out if too few of its n-grams with the least hashes occur
anywhere else: any partner would share more of them.

Null and empty texts, and texts without words, have no n-grams, link with
nothing and are their own component. Texts with fewer than n words have the
whole sequence as their one n-gram. N-grams are compared by 64-bit hashes of
their words. Repeated rows are documents of their own (with equal sets, so in
one component); rows with a null doc_id take part, and count for no smallest id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtrail.llm.byte_text import hash_words, lower_ascii, mix, ngram_hashes, slices, word_spans
from logtrail.llm.components import components, fresh_name, stored
from logtrail.llm.key_filter import among, bitmap, may_hold
from logtrail.session import configure

#: Points of a leaf and of a box; how many times more points a leaf has where nothing but points is dealt.
LEAF, BOX, WIDER = 128, 8, 4
#: N-grams per coordinate of a fine point, and its most coordinates.
FINE, MOST_GROUPS = 4, 1 << 13


def groups_for(percent: int) -> int:
    """Coordinates of a point: lower similarity leaves more room, so that large sets need finer counts to be told apart."""
    return 64 if percent >= 88 else 256


def fine_groups(size: np.ndarray, percent: int) -> np.ndarray:
    """Coordinates of the fine point of sets of these sizes: those of a point, doubled until few n-grams share one."""
    times = np.clip(size / (FINE * groups_for(percent)), 1, MOST_GROUPS // groups_for(percent))
    return groups_for(percent) << np.ceil(np.log2(times)).astype(np.int64)


def strong_from(percent: int) -> int:
    """N-grams of a block below which its key is weak; lower similarity makes more and smaller blocks."""
    return 3 if percent >= 88 else 2




def ngram_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of each text, sorted, and the number of the text of each."""
    data = lower_ascii(data)
    starts, ends, doc = word_spans(data, offsets)
    words = hash_words(data, starts, ends)
    grams, of = ngram_hashes(words, doc, n)
    count = np.bincount(doc, minlength=len(offsets) - 1)
    first = np.concatenate([[0], np.cumsum(count)])
    for k in range(1, n):
        short = np.flatnonzero(count == k)
        total = np.full(len(short), k, np.uint64)
        for j in range(k):
            total = mix(total * np.uint64(31) + words[first[short] + j])
        grams, of = np.concatenate([grams, total]), np.concatenate([of, short])
    order = within_texts(grams, of, len(offsets) - 1)
    grams, of = grams[order], of[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (of[1:] != of[:-1])
    return grams[new], of[new]


def within_texts(values: np.ndarray, of: np.ndarray, texts: int) -> np.ndarray:
    """Order by text number, then by value; equal values of a text come in any order."""
    order = np.argsort(values)
    # Numbers of 16 bits are sorted without a comparison.
    return order[np.argsort(of[order].astype(np.uint16 if texts <= 1 << 16 else np.int64), kind="stable")]


def set_ids(grams: np.ndarray, of: np.ndarray, rows: int) -> np.ndarray:
    """A 64-bit number per set, equal for equal sets."""
    total, size = np.zeros(rows, np.uint64), np.bincount(of, minlength=rows).astype(np.uint64)
    np.add.at(total, of, mix(grams ^ np.uint64(0x5851F42D4C957F2D)))
    return mix(total + size * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def points_of(grams: np.ndarray, of: np.ndarray, rows: int, groups: int) -> np.ndarray:
    """Counts of n-grams per group, a row per set."""
    group = (grams % np.uint64(groups)).astype(np.int64)
    return np.bincount(of * groups + group, minlength=rows * groups).reshape(rows, groups).astype(np.int32)


#: Forms of the counts of a point in bytes, and the least count that is too large for each; the first has two in a byte.
FORMS = (("u1", 1 << 4), ("u1", 1 << 8), ("<u2", 1 << 16), ("<u4", 1 << 32))


def packed(points: np.ndarray) -> pa.Array:
    """Each point in the shortest form that holds all its counts."""
    form = np.searchsorted([limit for _, limit in FORMS], points.max(1, initial=0), "right")
    out = np.full(len(points), b"", object)
    for k, (dtype, _) in enumerate(FORMS):
        rows = np.flatnonzero(form == k)
        counts = points[rows].astype(dtype)
        if k == 0:
            counts = counts[:, ::2] | counts[:, 1::2] << 4
        out[rows] = [row.tobytes() for row in counts]
    return pa.array(out, pa.binary())


def unpacked(column: list[bytes], groups: int) -> np.ndarray:
    """The points again; the number of bytes tells the form."""
    size, out = np.fromiter(map(len, column), np.int64, len(column)), np.zeros((len(column), groups), np.int32)
    for k, (dtype, _) in enumerate(FORMS):
        rows = np.flatnonzero(size == (groups * np.dtype(dtype).itemsize if k else groups // 2))
        counts = np.frombuffer(b"".join([column[r] for r in rows]), dtype).reshape(len(rows), groups if k else groups // 2)
        if k == 0:
            counts = np.stack([counts & 15, counts >> 4], 2).reshape(len(rows), groups)
        out[rows] = counts
    return out


def fine_points(sets: DataFrame, percent: int) -> DataFrame:
    """set_id, and the fine point of each set with the number of its coordinates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            grams, size = np.asarray(lists.flatten()).view(np.uint64), np.asarray(lists.value_lengths()).astype(np.int64)
            of, groups = np.repeat(np.arange(len(size)), size), fine_groups(size, percent)
            for g in np.unique(groups):
                rows = np.flatnonzero(groups == g)
                # Few points at a time where they are long.
                for some in np.array_split(rows, -(-len(rows) * int(g) // (1 << 20))):
                    number = np.full(len(size), -1)
                    number[some] = np.arange(len(some))
                    chosen = number[of] >= 0
                    point = packed(points_of(grams[chosen], number[of[chosen]], len(some), int(g)))
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(some)), pa.array(np.full(len(some), g, np.int32)), point], ["set_id", "groups", "point"])

    return sets.select("set_id", "grams").mapInArrow(run, "set_id bigint, groups int, point binary")


def folded(column: list[bytes], groups: np.ndarray) -> np.ndarray:
    """Fine points with as many coordinates as the coarsest of them: numbers of groups divide one another, so counts add up."""
    least = int(groups.min())
    out = np.zeros((len(column), least), np.int32)
    for g in np.unique(groups):
        rows = np.flatnonzero(groups == g)
        out[rows] = unpacked([column[r] for r in rows], int(g)).reshape(len(rows), -1, least).sum(1)
    return out


class SizeClasses:
    """Classes of sizes, and how many blocks the groups are cut into for each.

    With D blocks spoilt at most and w blocks more than D + 1, more than w
    blocks are the same in both documents. So one that has at most w blocks of
    fewer than ``spent`` n-grams shares a fuller one with every partner; only
    documents with more of them need their keys. The spare w covers most
    documents of a class.
    """

    def __init__(self, percent: int):
        self.percent, self.strong = percent, strong_from(percent)
        # Blocks that are spared: all weak ones, or the empty ones where sparing all would take too many blocks.
        self.spent = self.strong if percent >= 88 else 1
        bounds = [1]
        while bounds[-1] < 1 << 40:
            bounds.append(max(bounds[-1] + 1, bounds[-1] * 3 // 2))
        self._bounds = np.array(bounds, np.int64)
        # Both sizes are below the next class's bound: D <= 2 * (bound - 1) * (100 - p) / (100 + p).
        spoilt = 2 * (self._bounds[1:] - 1) * (100 - percent) // (100 + percent)
        spare = [self._spare(int(d), (low * high) ** 0.5) for d, low, high in zip(spoilt, bounds[:-1], bounds[1:], strict=True)]
        self._spare_of = np.append(np.array(spare, np.int64), 0)
        self._blocks = np.append(np.where(spoilt > 0, spoilt + 1 + self._spare_of[:-1], 1), 1)

    def _spare(self, spoilt: int, size: float) -> int:
        """Least w that covers the expected weak blocks of a set of that size and some more; bounded."""
        step = max(1, spoilt // 64)
        for w in range(0, spoilt // 2 + 1, step):
            blocks = spoilt + 1 + w
            mean = size / blocks
            weak = blocks * sum(math.exp(-mean) * mean**k / math.factorial(k) for k in range(self.spent))
            if w >= weak + 2 * math.sqrt(weak):
                return w
        return spoilt // 3

    def schemes(self, size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Class of each size with its blocks and spare, then the same of the next class for those that may link upwards (-1 for the others)."""
        own = np.maximum(np.searchsorted(self._bounds, size, "right") - 1, 0)
        yield own, self._blocks[own], self._spare_of[own]
        up = np.where(100 * size >= self.percent * self._bounds[own + 1], own + 1, -1)
        yield up, self._blocks[up], self._spare_of[up]


def block_keys(grams: np.ndarray, of: np.ndarray, size: np.ndarray, classes: SizeClasses) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Text number, key, and whether it is weak, of the blocks of every set that can be needed."""
    spread = mix(grams ^ np.uint64(0x2545F4914F6CDD1D))
    content = mix(grams + np.uint64(0x1B873593CC9E2D51))
    for scheme, blocks, spare in classes.schemes(size):
        # One block for all: only equal sets link, and those are one already.
        used = (scheme >= 0) & (blocks > 1)
        base = np.concatenate([[0], np.cumsum(np.where(used, blocks, 0))])
        take = used[of]
        at = base[of[take]] + (((spread[take] >> np.uint64(32)) * blocks[of[take]].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
        total = np.zeros(base[-1], np.uint64)
        np.add.at(total, at, content[take])
        count = np.bincount(at, minlength=base[-1])
        doc = np.repeat(np.arange(len(size)), np.where(used, blocks, 0))
        number = np.arange(base[-1]) - base[doc]
        key = mix(total + mix(scheme[doc].astype(np.uint64) << np.uint64(40) | number.astype(np.uint64)) + count.astype(np.uint64))
        weak = count < classes.strong
        spent = count < classes.spent
        needed = ~spent | (np.bincount(doc[spent], minlength=len(size)) > spare)[doc]
        yield doc[needed], key[needed].view(np.int64), weak[needed]


def _lists(doc: np.ndarray, values: np.ndarray, rows: int) -> pa.Array:
    """Values as a list per row; ``doc`` is sorted."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(rows + 1)).astype(np.int32)), pa.array(values))


def probes_of(grams: np.ndarray, of: np.ndarray, size: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the n-grams with the least hashes of each set, and how many of them a partner shares at least.

    A partner lacks (100 - p) percent of the n-grams at most, so it has all
    but so many of any others that are chosen; about a third more are.
    """
    lacking = (100 - percent) * size // 100
    number = np.minimum(lacking + np.maximum(1, -(-lacking * 3 // 10)), size)
    order = within_texts(mix(grams ^ np.uint64(0x5BF03635F0935AD1)), of, len(size))
    rank = np.arange(len(grams)) - (np.cumsum(size) - size)[of]
    return order[rank < number[of]], number - lacking


def probed(documents: DataFrame, n: int, percent: int) -> DataFrame:
    """The probes of all sets, a row each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in slices(batches):
            grams, of = ngram_sets(data, offsets, n)
            places, _ = probes_of(grams, of, np.bincount(of, minlength=batch.num_rows), percent)
            yield pa.RecordBatch.from_arrays([pa.array(mix(grams[places]).view(np.int64))], ["probe"])

    return documents.select("text").mapInArrow(run, "probe bigint")


def described(documents: DataFrame, n: int, percent: int, shared: Broadcast) -> DataFrame:
    """doc_id, key of the text, size and number of its set, its point, and strong and weak block keys.

    Sets of which too few probes are ``shared`` (a bitmap) have no partner, and so no keys.
    """
    classes, groups = SizeClasses(percent), groups_for(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in slices(batches):
            rows = batch.num_rows
            grams, of = ngram_sets(data, offsets, n)
            size = np.bincount(of, minlength=rows)
            places, least = probes_of(grams, of, size, percent)
            held = may_hold(shared.value, mix(grams[places]).view(np.int64))
            live = np.bincount(of[places][held], minlength=rows) >= least
            chosen = live[of]
            found = [np.concatenate(part) for part in zip(*block_keys(grams[chosen], of[chosen], np.where(live, size, 0), classes), strict=True)]
            order = np.argsort(found[0], kind="stable")
            doc, key, weak = (part[order] for part in found)
            ids = pa.array(set_ids(grams, of, rows), mask=size == 0)
            keys = [_lists(doc[chosen], key[chosen], rows) for chosen in (~weak, weak)]
            point = packed(points_of(grams, of, rows, groups))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(size, pa.int64()), ids, *keys, point], ["doc_id", "text_key", "size", "set_id", "strong", "weak", "point"])

    source = documents.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    return source.mapInArrow(run, "doc_id bigint, text_key bigint, size bigint, set_id bigint, strong array<bigint>, weak array<bigint>, point binary")


def sets_of(documents: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """set_id and n-grams of the wanted texts (``text_key, set_id``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in slices(batches):
            grams, of = ngram_sets(data, offsets, n)
            ids = set_ids(grams, of, batch.num_rows)
            # Another text with the same key is not the wanted one.
            right = pa.array(ids == np.asarray(batch.column(0)))
            rows = pa.RecordBatch.from_arrays([batch.column(0), _lists(of, grams.view(np.int64), batch.num_rows)], ["set_id", "grams"])
            yield rows.filter(right)

    texts = among(documents.select(F.xxhash64("text").alias("text_key"), "text"), "text_key", bitmap(wanted.select("text_key")))
    # Copies of a text meet in the join already, so that no set is made and shuffled only to be dropped.
    joined = texts.join(wanted, "text_key").dropDuplicates(["text_key", "set_id", "text"]).select("set_id", "text")
    return joined.mapInArrow(run, "set_id bigint, grams array<bigint>")


def only(sets: DataFrame, ids: DataFrame) -> DataFrame:
    """The sets that may be among ``ids`` (one column): the others need no shuffle."""
    return among(sets, "set_id", bitmap(ids))


def _boxes(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the points by coordinates, and the largest count per group of each box of ``BOX`` points."""
    order = np.lexsort(points.T[:4][::-1]) if len(points) else np.zeros(0, int)
    first = np.arange(0, len(points), BOX)
    return order, np.maximum.reduceat(points[order], first, 0) if len(points) else points


def close_points(points: np.ndarray, cut: int | None, percent: int) -> Iterator[tuple[int, int]]:
    """Pairs of points (within all, or across ``cut``) whose summed minima reach the overlap that a link needs."""
    size = points.sum(1)
    a, b = (points, points) if cut is None else (points[:cut], points[cut:])
    if not len(a) or not len(b):
        return
    order_a, top_a = _boxes(a)
    order_b, top_b = (order_a, top_a) if cut is None else _boxes(b)
    size_a, size_b = (size, size) if cut is None else (size[:cut], size[cut:])
    least_a = np.minimum.reduceat(size_a[order_a], np.arange(0, len(a), BOX))
    least_b = np.minimum.reduceat(size_b[order_b], np.arange(0, len(b), BOX))
    of_box = np.arange(len(b)) // BOX
    for i in range(len(top_a)):
        # A link needs an overlap of p * (x + y) / (100 + p) at least; a box's smallest sizes give the least of that.
        bound = np.minimum(top_a[i], top_b).sum(1)
        boxes = (100 + percent) * bound >= percent * (least_a[i] + least_b)
        if cut is None:
            boxes[:i] = False
        columns = order_b[boxes[of_box]]
        if not len(columns):
            continue
        rows = order_a[i * BOX : (i + 1) * BOX]
        overlap = np.minimum(a[rows][:, None, :], b[columns][None, :, :]).sum(2)
        close = (100 + percent) * overlap >= percent * (size_a[rows][:, None] + size_b[columns][None, :])
        for r, c in zip(*np.nonzero(close), strict=True):
            x, y = int(rows[r]), int(columns[c]) + (cut or 0)
            if x != y:
                yield x, y


def linked_pairs(sets: list[np.ndarray], cut: int | None, percent: int) -> list[tuple[int, int]]:
    """Links within some sets (sorted arrays), or across ``cut``, that connect all that is linked."""
    parent = list(range(len(sets)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    of = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    points = points_of(np.concatenate(sets).view(np.uint64), of, len(sets), groups_for(percent))
    out: list[tuple[int, int]] = []
    for x, y in close_points(points, cut, percent):
        if root(x) != root(y):
            shared = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
            if 100 * shared >= percent * (len(sets[x]) + len(sets[y]) - shared):
                parent[root(y)] = root(x)
                out.append((x, y))
    return out


def dealt_leaves(members: DataFrame, percent: int, wider: int = 1) -> DataFrame:
    """Every member (with ``grp``, ``set_id``, ``size``, ``core``) once per pair of leaves it belongs to: l1, l2, r1, r2, is_left.

    Members of a group's core are known to be connected, and are compared with the others alone. Leaves without a
    member of a size that can link, and a leaf of one member with itself, are no pairs.
    """
    size = F.col("size")
    # Sizes of linked sets lie in the same or in neighbouring bands; each band has leaves of the core and of the others.
    band = F.floor(F.log(size.cast("double")) / F.log(F.lit(100.0 / percent)))
    rows = stored(members.withColumn("zone", 2 * band + F.col("core").cast("bigint")), "members")
    # Sizes lie in some hundred bands at most, so the map of a group is small.
    count = F.count("*")
    leaves = rows.groupBy("grp", "zone").agg(F.ceil(count / F.lit(wider * LEAF)).cast("int").alias("leaves"), count.alias("n"), F.min(size).alias("low"), F.max(size).alias("high"))
    leaves = stored(leaves.groupBy("grp").agg(F.map_from_entries(F.collect_list(F.struct("zone", F.struct("leaves", "n", "low", "high")))).alias("zones")), "leaves")
    dealt = rows.join(leaves, "grp")
    own = F.struct("zone", F.pmod(F.xxhash64("set_id"), F.try_element_at("zones", F.col("zone"))["leaves"]).alias("slot"))
    outside = [2 * (F.floor(F.col("zone") / 2) + step) for step in (-1, 0, 1)]
    zones = F.when(F.col("core"), F.array(*outside)).otherwise(F.array(*outside, *[zone + 1 for zone in outside]))

    def fits(zone):
        there = F.try_element_at(F.col("zones"), zone)
        alone = (zone == F.col("zone")) & (there["n"] == 1)
        return there.isNotNull() & ~alone & (100 * there["high"] >= percent * size) & (percent * there["low"] <= 100 * size)

    partners = F.flatten(
        F.transform(
            F.filter(zones, fits),
            lambda zone: F.transform(
                F.sequence(F.lit(0), F.try_element_at(F.col("zones"), zone)["leaves"] - 1),
                lambda slot: F.struct(zone.alias("zone"), slot.cast("bigint").alias("slot")),
            ),
        )
    )
    dealt = dealt.withColumn("own", own).withColumn("other", F.explode(partners))
    pair = {"l1": F.least("own", "other")["zone"], "l2": F.least("own", "other")["slot"], "r1": F.greatest("own", "other")["zone"], "r2": F.greatest("own", "other")["slot"]}
    return dealt.withColumns(pair | {"is_left": F.col("own") <= F.col("other")}).drop("own", "other", "zone", "zones", "core", "size")


_PAIR = ("grp", "l1", "l2", "r1", "r2")


def _arranged(table: pa.Table) -> tuple[pa.Table, int | None]:
    """The left leaf's rows, then the right one's, and where these begin; None for a leaf with itself."""
    if table.column("l1")[0] == table.column("r1")[0] and table.column("l2")[0] == table.column("r2")[0]:
        return table, None
    left = np.asarray(table.column("is_left"))
    return table.take(pa.array(np.concatenate([np.flatnonzero(left), np.flatnonzero(~left)]))), int(left.sum())


def _pairs(ids: np.ndarray, found: list[tuple[int, int]]) -> pa.Table:
    return pa.table({"a": pa.array([ids[x] for x, _ in found], pa.int64()), "b": pa.array([ids[y] for _, y in found], pa.int64())})


def links(members: DataFrame, sets: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """Links (``a, b``) within families: ``members`` has ``grp, set_id``; at least what connects all that is linked.

    Every member is first compared with the one that its family is named by. Those that link with it are the family's
    core; only families with others go on, and their core is not compared with itself. Leaves get fine points first,
    and whole sets only of the members that some point of the other leaf is close to.
    """

    def near(table: pa.Table) -> pa.Table:
        table, cut = _arranged(table)
        points = folded(table.column("point").to_pylist(), np.asarray(table.column("groups")))
        held = np.zeros(table.num_rows, bool)
        for pair in close_points(points, cut, percent):
            held[list(pair)] = True
        return table.select([*_PAIR, "is_left", "set_id"]).filter(pa.array(held))

    def join(table: pa.Table) -> pa.Table:
        table, cut = _arranged(table)
        grams = table.column("grams").combine_chunks()
        values, offsets = np.asarray(grams.flatten()), np.concatenate([[0], np.cumsum(np.asarray(grams.value_lengths()))])
        found = linked_pairs([values[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)], cut, percent)
        return _pairs(np.asarray(table.column("set_id")), found)

    star = stored(members.where("grp <> set_id").select(F.col("set_id").alias("a"), F.col("grp").alias("b")), "star-pairs")
    star = stored(verified(star, sets, points, percent), "star")
    core = star.select(F.col("a").alias("set_id")).withColumn("core", F.lit(True))
    marked = members.join(core, "set_id", "left").withColumn("core", F.coalesce("core", F.col("grp") == F.col("set_id")))
    marked = stored(marked, "marked")
    open_families = marked.where("not core").select("grp").distinct()
    sizes = sets.select("set_id", F.size("grams").cast("bigint").alias("size"))
    # Dealt before the sets come in: most of a core has no partner left to compare with.
    dealt = stored(dealt_leaves(marked.join(open_families, "grp", "left_semi").join(sizes, "set_id"), percent), "dealt")
    dealt = dealt.select(*_PAIR, "is_left", "set_id").join(only(points, dealt.select("set_id")), "set_id")
    schema = "grp bigint, l1 bigint, l2 bigint, r1 bigint, r2 bigint, is_left boolean, set_id bigint"
    dealt = stored(dealt.groupBy(*_PAIR).applyInArrow(near, schema), "near")
    dealt = dealt.join(only(sets, dealt.select("set_id")), "set_id")
    return star.unionByName(dealt.groupBy(*_PAIR).applyInArrow(join, "a bigint, b bigint"))


def close_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Pairs that the points leave, across families: ``members`` has ``grp, set_id, family, size, point``."""

    def join(table: pa.Table) -> pa.Table:
        table, cut = _arranged(table)
        points = unpacked(table.column("point").to_pylist(), groups)
        family = np.asarray(table.column("family"))
        found = [(x, y) for x, y in close_points(points, cut, percent) if family[x] != family[y]]
        return _pairs(np.asarray(table.column("set_id")), found)

    groups = groups_for(percent)
    # The family that most members of a key belong to needs no comparison within.
    counts = members.groupBy("grp", "family").agg(F.count("*").alias("n"))
    main = stored(counts.groupBy("grp").agg(F.max_by("family", F.struct("n", "family")).alias("main")), "main")
    marked = members.join(main, "grp").withColumn("core", F.col("family") == F.col("main")).drop("main")
    dealt = dealt_leaves(marked, percent, WIDER)
    return dealt.groupBy(*_PAIR).applyInArrow(join, "a bigint, b bigint").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def verified(pairs: DataFrame, sets: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """The pairs whose whole sets are similar enough; only sets of pairs with close fine points are shuffled."""

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups = [np.asarray(batch.column(c)) for c in ("_ga", "_gb")]
            kept = np.zeros(batch.num_rows, bool)
            kinds = groups[0].astype(np.int64) << 32 | groups[1]
            for kind in np.unique(kinds):
                rows = np.flatnonzero(kinds == kind)
                for some in np.array_split(rows, -(-len(rows) * int(kind >> 32) // (1 << 20))):
                    place = pa.array(some)
                    columns = batch.column("_pa").take(place).to_pylist() + batch.column("_pb").take(place).to_pylist()
                    both = folded(columns, np.concatenate([g[some] for g in groups]))
                    overlap = np.minimum(both[: len(some)], both[len(some) :]).sum(1)
                    kept[some] = (100 + percent) * overlap >= percent * (both[: len(some)].sum(1) + both[len(some) :].sum(1))
            yield batch.select(["a", "b"]).filter(pa.array(kept))

    for c in ("a", "b"):
        pairs = pairs.join(only(points, pairs.select(c)).select(F.col("set_id").alias(c), F.col("groups").alias(f"_g{c}"), F.col("point").alias(f"_p{c}")), c)
    pairs = stored(pairs.select("a", "b", "_ga", "_gb", "_pa", "_pb").mapInArrow(close, "a bigint, b bigint"), "close")
    left, right = (only(sets, pairs.select(c)).select(F.col("set_id").alias(c), F.col("grams").alias(f"_{c}")) for c in ("a", "b"))
    both = pairs.join(left, "a").join(right, "b").withColumn("_shared", F.size(F.array_intersect("_a", "_b")))
    return both.where(100 * F.col("_shared") >= percent * (F.size("_a") + F.size("_b") - F.col("_shared"))).select("a", "b")


def classes(documents: DataFrame, n: int, percent: int) -> DataFrame:
    """doc_id, text_key, size and class of every row; the class is null without n-grams."""
    configure(documents.sparkSession)
    counts = probed(documents, n, percent).groupBy("probe").agg(F.count("*").alias("n")).where("n > 1").select("probe")
    rows = stored(described(documents, n, percent, bitmap(counts)), "described")
    some = rows.where("set_id is not null")
    keys = some.select("set_id", F.explode("strong").alias("key"), F.lit(False).alias("weak"))
    keys = keys.unionByName(some.select("set_id", F.explode("weak").alias("key"), F.lit(True).alias("weak")))
    shared = keys.groupBy("key").agg(F.min("set_id").alias("pivot"), F.max("set_id").alias("_last")).where("pivot <> _last").drop("_last")
    shared = stored(shared, "keys")
    met = stored(_meeting(some, bitmap(shared.select("key"))).join(shared, "key").select("key", "weak", "set_id", "pivot"), "met")
    families = stored(components(met.where("not weak").select("set_id", "pivot").distinct()), "families").withColumnRenamed("node", "set_id").withColumnRenamed("component", "family")
    weak = met.where("weak").select("key", "set_id").distinct().join(families, "set_id", "left").withColumn("family", F.coalesce("family", "set_id"))
    weak = stored(weak, "weak")
    across = stored(weak.groupBy("key").agg(F.min("family").alias("_f"), F.max("family").alias("_l")).where("_f <> _l").select("key"), "across")
    one = stored(some.groupBy("set_id").agg(F.min("text_key").alias("text_key"), F.min("size").alias("size"), F.min("point").alias("point")), "nodes")
    loose = weak.join(across, "key").withColumnRenamed("key", "grp").join(one.select("set_id", "size", "point"), "set_id")
    pairs = stored(close_pairs(loose, percent), "pairs")
    wanted = families.select("set_id").unionByName(pairs.select(F.col("a").alias("set_id"))).unionByName(pairs.select(F.col("b").alias("set_id"))).distinct()
    wanted = stored(one.select("set_id", "text_key").join(wanted, "set_id"), "wanted")
    sets = stored(sets_of(documents, wanted, n), "sets")
    points = stored(fine_points(sets, percent), "fine-points")
    found = links(families.withColumnRenamed("family", "grp"), sets, points, percent).unionByName(verified(pairs, sets, points, percent))
    labels = stored(components(stored(found, "links")), "labels").withColumnRenamed("node", "set_id")
    slim = rows.select("doc_id", "text_key", "size", "set_id").join(labels, "set_id", "left")
    return stored(slim.withColumn("class", F.coalesce("component", "set_id")).drop("component", "set_id"), "classes")


def _meeting(rows: DataFrame, bits) -> DataFrame:
    """key, weak, set_id of the block keys that may be shared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.asarray(batch.column(0))
            for column, weak in ((1, False), (2, True)):
                lists = batch.column(column)
                keys, owner = np.asarray(lists.flatten()), np.repeat(ids, np.asarray(lists.value_lengths()))
                held = may_hold(bits.value, keys)
                yield pa.RecordBatch.from_arrays([pa.array(keys[held]), pa.array(np.full(int(held.sum()), weak)), pa.array(owner[held])], ["key", "weak", "set_id"])

    return rows.select("set_id", "strong", "weak").mapInArrow(run, "key bigint, weak boolean, set_id bigint")


def near_duplicates(documents: DataFrame, n: int, percent: int) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id of the class) of every row of ``documents``."""
    rows = classes(documents, n, percent)
    first = stored(rows.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("component_id")), "firsts")
    return rows.join(first, "class", "left").select("doc_id", F.col("size").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(documents: DataFrame, n: int, percent: int) -> DataFrame:
    """The documents, of each class the one with the smallest doc_id (nulls last), once; those without n-grams all stay."""
    rows = classes(documents, n, percent).where("class is not null")
    order = F.struct(F.col("doc_id").isNull().alias("_n"), "doc_id", "text_key")
    first = stored(rows.groupBy("class").agg(F.min(order).alias("first")), "firsts")
    told = rows.join(first, "class").select("doc_id", "text_key", (order == F.col("first")).alias("stays"))
    told = told.groupBy("doc_id", "text_key").agg(F.bool_or("stays").alias("stays"), F.count("*").alias("n")).where("n > 1 or not stays")
    told = stored(told.select(F.col("doc_id").alias("_doc"), F.col("text_key").alias("_text"), "stays"), "told")
    key = fresh_name(documents, "text_key")
    keyed = documents.withColumn(key, F.xxhash64("text"))
    bits = bitmap(told.select("_text"))

    def chosen(held: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keys = np.asarray(batch.column(batch.num_columns - 1))
                yield batch.filter(pa.array(may_hold(bits.value, keys) == held))

        return keyed.mapInArrow(run, keyed.schema)

    # Only texts that some row loses are shuffled; the rest stays where it is.
    stays = fresh_name(keyed, "stays")
    match = chosen(True).join(told.withColumnRenamed("stays", stays), F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col(key) == F.col("_text")), "left").drop("_doc", "_text")
    match = stored(match, "matched")
    alone = match.where(F.col(stays).isNull()).drop(stays)
    once = match.where(F.col(stays)).drop(stays).dropDuplicates(["doc_id", key])
    return chosen(False).unionByName(alone).unionByName(once).drop(key)
