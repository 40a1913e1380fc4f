"""Removes byte strings of a fixed length that occur more than once in a corpus.

Every window of ``length`` bytes belongs to the anchor with the least hash in
it (the leftmost of equal ones), so equal windows have equal anchors at equal
places. A piece is all that windows of one anchor cover. Pieces are grouped by
anchor:

* a piece that occurs again as a whole is repeated, by its counted digest;
* groups with one content are done with that, and most are;
* other groups go to shards of about ``SHARD`` bytes. A shard's distinct
  pieces are joined to one text; induced sorting gives its suffix array, and
  permuted common prefixes of at least ``length`` mark the repeated windows;
* a group too large for a shard is cut into ``WAYS`` ranges of windows, keyed
  by the bytes that all windows of a range share. That makes groups anew, which
  are done, go to shards or are cut again in the same way.

Only texts that hold such pieces are shuffled. Marked windows become spans of
bytes per text, and what is left is digested. Texts equal to another one need
no marks: all of them goes if they have ``length`` bytes.

A text longer than ``TEXT`` is taken in overlapping parts; a piece that lies over
their border is two pieces of one anchor then.

Null counts as empty. Texts shorter than ``length`` keep all bytes. Repeated
rows are copies of each other whatever their doc_id, null doc_ids included.
Equality of whole pieces and texts is that of 128-bit digests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtrail.llm.byte_text import PrefixHash, slices
from logtrail.llm.components import stored
from logtrail.llm.key_filter import among, bitmap, may_hold
from logtrail.llm.suffix_sort import common_prefixes, suffix_array
from logtrail.session import configure

#: Bytes of an anchor (longer than common lines, so that these make no groups), of a shard, and of the pieces of a
#: group that goes to a shard; ranges that a larger group is cut into; bytes of text, and rows of cuts, in one step.
ANCHOR, SHARD, GROUP, WAYS, TEXT, ROWS = 128, 256 << 10, 128 << 10, 4, 128 << 10, 512

_ROWS = "text_id binary, anchor bigint, digest binary, begin int, size int"


def anchors(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per piece: text number, first byte, size, and place of its anchor (all counted from the begin of ``data``)."""
    span = length - ANCHOR + 1
    grams = len(data) - ANCHOR + 1
    size = np.diff(offsets)
    windows = np.maximum(size - length + 1, 0)
    if grams < 1 or not windows.any():
        return (np.zeros(0, np.int64),) * 4
    at = np.arange(grams)
    # Leftmost minimum over each run of ``span`` anchors: block-wise running minima from both sides.
    hashes = PrefixHash(data).spans(at, at + ANCHOR)
    blocks = -(-grams // span)
    padded = np.full(blocks * span, np.iinfo(np.uint64).max, np.uint64)
    padded[:grams] = hashes
    table = padded.reshape(blocks, span)
    column = np.arange(span)
    # Running minima with their places, the earlier place winning ties.
    low = np.minimum.accumulate(table, 1)
    fresh = np.concatenate([np.ones((blocks, 1), bool), table[:, 1:] < low[:, :-1]], 1)
    low_at = np.maximum.accumulate(np.where(fresh, column, 0), 1)
    back = table[:, ::-1]
    high = np.minimum.accumulate(back, 1)
    fresh = np.concatenate([np.ones((blocks, 1), bool), back[:, 1:] <= high[:, :-1]], 1)
    high_at = np.maximum.accumulate(np.where(fresh, column, 0), 1)
    high, high_at = high[:, ::-1], span - 1 - high_at[:, ::-1]
    number = np.repeat(np.arange(len(size)), windows)
    first = np.repeat(np.cumsum(windows) - windows, windows)
    begin = offsets[number] + np.arange(len(number)) - first
    end = begin + span - 1
    left, right = high[begin // span, begin % span], low[end // span, end % span]
    place = np.where(left <= right, begin // span * span + high_at[begin // span, begin % span], end // span * span + low_at[end // span, end % span])
    new = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (number[1:] != number[:-1])]))
    last = np.append(new[1:], len(number)) - 1
    return number[new], begin[new], begin[last] + length - begin[new], place[new]


def _in_parts(data: np.ndarray, offsets: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The bytes as they are, or of one text longer than ``TEXT`` parts that hold each of its windows once: first byte, bytes, offsets."""
    if len(offsets) != 2 or len(data) <= TEXT + length:
        yield 0, data, offsets
        return
    for at in range(0, len(data) - length + 1, TEXT):
        part = data[at : at + TEXT + length - 1]
        yield at, part, np.array([0, len(part)])


def _digest(anchor_at: int, part: memoryview) -> bytes:
    return xxhash.xxh3_128_digest(part, seed=anchor_at)


def pieces(documents: DataFrame, length: int) -> DataFrame:
    """A row per piece of every text: text, anchor's hash, digest of content and anchor's place, first byte and size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in slices(batches, limit=TEXT):
            for first, part, bounds in _in_parts(data, offsets, length):
                doc, begin, size, at = anchors(part, bounds, length)
                view = memoryview(np.ascontiguousarray(part))
                digest = [_digest(a - b, view[b : b + s]) for b, s, a in zip(begin.tolist(), size.tolist(), at.tolist(), strict=True)]
                hashes = PrefixHash(part).spans(at, at + ANCHOR).view(np.int64)
                columns = [batch.column(0).take(pa.array(doc)), pa.array(hashes), pa.array(digest, pa.binary()), pa.array((first + begin - bounds[doc]).astype(np.int32)), pa.array(size.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, ["text_id", "anchor", "digest", "begin", "size"])

    return documents.select("text_id", "text").mapInArrow(run, _ROWS)


def with_text_id(documents: DataFrame) -> DataFrame:
    """doc_id, text, 128-bit digest of the text, and a bigint of it."""
    text = F.coalesce("text", F.lit(""))
    return documents.select("doc_id", text.alias("text"), F.unhex(F.md5(text)).alias("text_id"), F.xxhash64(text).alias("text_key"))


def fetch(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of one place per piece: ``wanted`` has text_id, text_key, anchor, digest, begin, size, and the bytes of the group."""
    bits = bitmap(wanted.select("text_key"))
    texts = among(documents.select("text_id", "text", "text_key"), "text_key", bits).drop("text_key")
    # The pieces of one text are bounded by the text.
    lists = wanted.groupBy("text_id").agg(F.collect_list(F.struct("anchor", "digest", "begin", "size", "bytes")).alias("parts"))
    lists = stored(lists, "wanted")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Copies of a text meet in a task, but where Spark splits a join; a shard drops what is left of them.
        seen = set()
        for batch in batches:
            for text_id, text, parts in zip(*batch.columns, strict=True):
                if text_id.as_py() in seen:
                    continue
                seen.add(text_id.as_py())
                raw = text.as_py().encode()
                yield pa.RecordBatch.from_pylist(
                    [{"anchor": p["anchor"], "digest": p["digest"], "bytes": p["bytes"], "data": raw[p["begin"] : p["begin"] + p["size"]]} for p in parts.as_py()],
                    pa.schema([("anchor", pa.int64()), ("digest", pa.binary()), ("bytes", pa.int64()), ("data", pa.binary())]),
                )

    joined = texts.join(lists, "text_id").select("text_id", "text", "parts")
    return joined.mapInArrow(cut, "anchor bigint, digest binary, bytes bigint, data binary")


def repeated_windows(parts: list[bytes], length: int) -> list[np.ndarray]:
    """Begins of the windows of each part that occur elsewhere in the parts, by suffix array."""
    size = np.array([len(p) for p in parts])
    text = np.zeros(int(size.sum()) + len(parts), np.int32)
    begin = np.concatenate([[0], np.cumsum(size + 1)[:-1]])
    inside = np.arange(len(text)) - np.repeat(begin, size + 1) < np.repeat(size, size + 1)
    text[inside] = np.frombuffer(b"".join(parts), np.uint8).astype(np.int32) + 1
    before, shared = common_prefixes(text, suffix_array(text, 257), int(size.max(initial=0)) + length, begin)
    long = np.flatnonzero(shared >= length)
    marked = np.zeros(len(text), bool)
    marked[long] = True
    marked[before[long]] = True
    return [np.flatnonzero(marked[b : b + max(s - length + 1, 0)]) for b, s in zip(begin.tolist(), size.tolist(), strict=True)]


def _spans(starts: np.ndarray, length: int) -> list[dict]:
    """Runs of window begins as spans of bytes."""
    if not len(starts):
        return []
    first = np.concatenate([[True], np.diff(starts) > length])
    last = np.concatenate([first[1:], [True]])
    return [{"b": int(b), "e": int(e) + length} for b, e in zip(starts[first], starts[last], strict=True)]


_SPANS = pa.list_(pa.struct([("b", pa.int32()), ("e", pa.int32())]))


def _distinct(table: pa.Table) -> pa.Table:
    """The rows without copies of a piece."""
    first: dict[tuple, int] = {}
    for row, piece in enumerate(zip(*(table.column(c).to_pylist() for c in ("grp", "anchor", "digest", "off", "data")), strict=True)):
        first.setdefault(piece, row)
    return table if len(first) == table.num_rows else table.take(pa.array(list(first.values())))


def in_shards(groups: DataFrame, length: int) -> DataFrame:
    """anchor, digest and repeated spans of the pieces (``grp, anchor, digest, off, bytes, data``) of groups that fit a shard.

    ``data`` begins ``off`` bytes behind the begin of the piece that ``anchor, digest`` name; without an anchor it is
    only there for others to be found in.
    """

    def sort(table: pa.Table) -> pa.Table:
        table = _distinct(table)
        found = [_spans(w, length) for w in repeated_windows([d.as_py() for d in table.column("data")], length)]
        spans = [[{"b": s["b"] + off, "e": s["e"] + off} for s in some] for some, off in zip(found, table.column("off").to_pylist(), strict=True)]
        out = pa.table({"anchor": table.column("anchor"), "digest": table.column("digest"), "spans": pa.array(spans, _SPANS)})
        return out.filter(pa.array([bool(f) and a is not None for f, a in zip(found, table.column("anchor").to_pylist(), strict=True)], pa.bool_()))

    total = groups.agg(F.coalesce(F.sum(F.octet_length("data")), F.lit(0))).first()[0]
    dealt = groups.withColumn("shard", F.pmod(F.xxhash64("grp"), F.lit(max(1, -(-total // SHARD)))))
    return dealt.select("shard", "grp", "anchor", "digest", "off", "data").groupBy("shard").applyInArrow(sort, "anchor bigint, digest binary, spans array<struct<b:int,e:int>>")


def _few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``ROWS`` rows, as each row becomes several."""
    for batch in batches:
        for begin in range(0, batch.num_rows, ROWS):
            yield batch.slice(begin, ROWS)


def cut_ranges(data: bytes, at: int, core: int, length: int) -> Iterator[tuple[int, int, int, int]]:
    """A piece whose windows all hold the ``core`` bytes at ``at``, cut into ranges of windows by how far the core is from their begin.

    Equal windows agree in that, so they are in the same range. Per range that the piece has windows of: first byte,
    end, and where the bytes that all windows of that range share begin and end.
    """
    least, most = max(at - (len(data) - length), 0), min(at, length - core)
    step = max(-(-(length - core + 1) // WAYS), 1)
    for low in range(least // step * step, most + 1, step):
        high = min(low + step - 1, length - core)
        yield at - min(high, most), at - max(low, least) + length, at - low, at - high + length


def in_cuts(groups: DataFrame, length: int) -> DataFrame:
    """The same for pieces (``grp, anchor, digest, off, data, at``; ``at``: the anchor's place) of groups that do not fit.

    Such a group is cut into ``WAYS`` ranges of windows, and grouped anew by the bytes that all windows of a range
    share. What occurs again as a whole is repeated, what shares those bytes with nothing else is not; other groups
    go to shards, or are cut again if they are still too large.
    """

    def cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _few(batches):
            rows = []
            for grp, anchor, digest, off, data, at, core in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for b, e, first, last in cut_ranges(data, at, core, length):
                    key = xxhash.xxh3_64_intdigest(data[first:last], seed=(grp + at - first) % (1 << 64)) - (1 << 63)
                    part = data[b:e]
                    rows.append({"grp": key, "content": _digest(first - b, part), "anchor": anchor, "digest": digest, "off": off + b, "data": part, "at": first - b, "core": last - first})
            yield pa.RecordBatch.from_pylist(rows, _CUT)

    columns = ["grp", "anchor", "digest", "off", "data", "at", "core"]
    open_ = groups.withColumn("core", F.lit(ANCHOR)).select(*columns)
    found = None
    while not open_.isEmpty():
        made = stored(open_.mapInArrow(cuts, "grp bigint, content binary, anchor bigint, digest binary, off int, data binary, at int, core int"), "cuts")
        # Of equal cuts one goes on, for others to be found in, and names no piece.
        one = F.struct("anchor", "digest", "off", "data", "at", "core")
        counted = stored(made.groupBy("grp", "content").agg(F.count("*").alias("n"), F.min(one).alias("one")), "cut-counts")
        again = made.where("anchor is not null").join(counted.where("n > 1").select("grp", "content"), ["grp", "content"])
        again = again.select("anchor", "digest", F.array(F.struct(F.col("off").alias("b"), (F.col("off") + F.octet_length("data")).alias("e"))).alias("spans"))
        named = (F.col("n") == 1) & F.col("one.anchor").isNotNull()
        sizes = counted.groupBy("grp").agg(F.count("*").alias("contents"), F.sum(F.octet_length("one.data")).alias("bytes"), F.max(named).alias("asks"))
        sizes = stored(sizes.where("contents > 1 and asks").select("grp", "bytes"), "cut-groups")
        rest = among(counted.select("grp", "n", "one"), "grp", bitmap(sizes.select("grp"))).join(sizes, "grp")
        rest = rest.select("grp", "bytes", F.when(F.col("n") == 1, F.col("one.anchor")).alias("anchor"), *(F.col(f"one.{c}").alias(c) for c in columns[2:]))
        rest = stored(rest, "cuts-left")
        # A range of one window is what its windows share, so no group is left of these.
        level = again.unionByName(in_shards(rest.where(F.col("bytes") <= GROUP), length))
        found = level if found is None else found.unionByName(level)
        open_ = rest.where(F.col("bytes") > GROUP).select(*columns)
    return found


_CUT = pa.schema([("grp", pa.int64()), ("content", pa.binary()), ("anchor", pa.int64()), ("digest", pa.binary()), ("off", pa.int32()), ("data", pa.binary()), ("at", pa.int32()), ("core", pa.int32())])


def removed_spans(documents: DataFrame, length: int) -> DataFrame:
    """``text_id, spans`` of every text with repeated windows; ``documents`` as of ``with_text_id``.

    The span of a text that another row equals is (0, -1): all of it.
    """
    # Copies of a text tell nothing new but that they are copies.
    copies = stored(documents.where(F.octet_length("text") >= length).groupBy("text_id").agg(F.count("*").alias("n"), F.min("text_key").alias("text_key")), "texts")
    rows = stored(pieces(documents, length), "pieces")
    counted = rows.groupBy("anchor", "digest").agg(F.count("*").alias("n"), F.min(F.struct("text_id", "begin", "size")).alias("one"))
    counted = stored(counted, "piece-counts")
    groups = counted.groupBy("anchor").agg(F.count("*").alias("contents"), F.sum("one.size").alias("bytes"))
    groups = stored(groups.where("contents > 1").select("anchor", "bytes"), "groups")
    wanted = among(counted.select("anchor", "digest", "one.text_id", "one.begin", "one.size"), "anchor", bitmap(groups.select("anchor"))).join(groups, "anchor")
    wanted = stored(wanted.join(copies.select("text_id", "text_key"), "text_id"), "wanted")
    parts = stored(fetch(documents, wanted), "parts").select(F.col("anchor").alias("grp"), "anchor", "digest", F.lit(0).alias("off"), "bytes", "data")
    found = in_shards(parts.where(F.col("bytes") <= GROUP), length)
    large = parts.where(F.col("bytes") > GROUP)
    if not large.isEmpty():
        found = found.unionByName(in_cuts(stored(_with_anchor_place(large.dropDuplicates(["anchor", "digest"])), "placed"), length))
    whole = counted.where("n > 1").select("anchor", "digest", F.array(F.struct(F.lit(0).alias("b"), F.col("one.size").alias("e"))).alias("spans"))
    found = stored(found.unionByName(whole).select("anchor", "digest", F.explode("spans").alias("s")), "found")
    single = copies.where("n = 1").select("text_id")
    # Most pieces have no repeated span: they are left out before the shuffle.
    piece = F.xxhash64("anchor", "digest").alias("piece")
    marked = among(rows.select("*", piece), "piece", bitmap(found.select(piece))).drop("piece")
    marks = marked.join(found, ["anchor", "digest"]).select("text_id", (F.col("begin") + F.col("s.b")).alias("b"), (F.col("begin") + F.col("s.e")).alias("e")).distinct()
    marks = stored(marks, "marks")
    # The marks of one text are bounded by the text.
    spans = marks.join(single, "text_id").groupBy("text_id").agg(F.collect_list(F.struct("b", "e")).alias("spans"))
    all_of_it = copies.where("n > 1").select("text_id", F.array(F.struct(F.lit(0).alias("b"), F.lit(-1).alias("e"))).alias("spans"))
    return stored(spans.unionByName(all_of_it).join(copies.select("text_id", "text_key"), "text_id"), "spans")


def _with_anchor_place(parts: DataFrame) -> DataFrame:
    """The pieces and where their anchor is: the leftmost least hash of any of their windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = []
            for anchor, data in zip(batch.column(1).to_pylist(), batch.column(4).to_pylist(), strict=True):
                raw = np.frombuffer(data, np.uint8)
                k = np.arange(len(raw) - ANCHOR + 1)
                at.append(int(np.flatnonzero(PrefixHash(raw).spans(k, k + ANCHOR).view(np.int64) == anchor)[0]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int32())], [*batch.schema.names, "at"])

    return parts.select("grp", "anchor", "digest", "off", "data").mapInArrow(run, "grp bigint, anchor bigint, digest binary, off int, data binary, at int")


def cut_text(raw: bytes, spans: list[tuple[int, int]]) -> tuple[int, int, bytes]:
    """Removed bytes, removed runs, and what is left."""
    runs: list[list[int]] = []
    for b, e in sorted((b, len(raw) if e < 0 else e) for b, e in spans):
        if runs and b <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], e)
        else:
            runs.append([b, e])
    out, at = [], 0
    for b, e in runs:
        out.append(raw[at:b])
        at = e
    out.append(raw[at:])
    return sum(e - b for b, e in runs), len(runs), b"".join(out)


_RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def without_repeats(documents: DataFrame, length: int) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row."""
    configure(documents.sparkSession)
    rows = with_text_id(documents)
    spans = removed_spans(rows, length)
    bits = bitmap(spans.select("text_key"))

    def results(ids: pa.Array, texts: list[bytes], spans: list[list[tuple[int, int]]]) -> pa.RecordBatch:
        found = [(len(t), *cut_text(t, s)) for t, s in zip(texts, spans, strict=True)]
        columns = [pa.array([f[k] for f in found], pa.int64()) for k in range(3)]
        kept = pa.array([hashlib.sha256(f[3]).hexdigest() for f in found], pa.string())
        return pa.RecordBatch.from_arrays([ids, *columns, kept], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    def whole_texts(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
        for part, data, offsets in slices(iter([batch])):
            yield part, [data[b:e].tobytes() for b, e in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]

    def untouched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(~may_hold(bits.value, np.asarray(batch.column(2)))))
            for part, texts in whole_texts(batch):
                yield results(part.column(0), texts, [[]] * part.num_rows)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in whole_texts(batch):
                found = [[(s["b"], s["e"]) for s in parts or []] for parts in part.column(2).to_pylist()]
                yield results(part.column(0), texts, found)

    source = rows.select("doc_id", "text", "text_key", "text_id")
    plain = source.mapInArrow(untouched, _RESULT)
    changed = among(source, "text_key", bits).join(spans.drop("text_key"), "text_id", "left").select("doc_id", "text", "spans")
    return plain.unionByName(changed.mapInArrow(cut, _RESULT))
