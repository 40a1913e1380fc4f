"""Token ids in binary shards, found by document key through a minimal perfect hash.

``write`` sorts documents by key over all tasks, encodes them and writes three
things below one folder of the shared file system:

* shards: the ids of documents in ascending order of their keys, back to back,
  each document closed by an end id, as little-endian integers of 2 bytes (4
  where the vocabulary needs it); behind them the keys and where each begins;
* an index: keys are dealt by hash to buckets of a bounded number of keys. A
  bucket's file holds a minimal perfect hash, and per slot the key's
  fingerprint and its places (shard, first document, number of documents);
* two small tables, of the shards with the number of ids before each, and of
  the buckets.

The hash has levels of bits. A key takes the bit that its hash names, if no
other key of its level names it; the others go to the next level. Its slot is
the number of bits set before its own. A lookup takes a few reads of a few
bytes each, whatever the number of keys; many keys read a bucket once. Keys that
are not there mostly fail the fingerprint, and always the key in the shard.

Every file has a name of its own per attempt of a task, and only files named in
the tables count, so a lost executor costs tasks and leaves nothing false.

Texts are cut at white space, and each distinct word that a worker does not
remember is encoded by the tokenizers library. That gives the ids of whole texts
for tokenizers that make small letters of capital ones and whose pieces hold no
white space and no letters beside signs; others are refused.

* null texts count as empty: such a document is its end id;
* null keys are not in the index: ``read(…, unkeyed=True)`` gives their documents;
* rows that share a key are found together, in an order by their text;
* an empty table gives no shards; columns other than key and text do not matter;
* one text is held whole, and some 40 bytes per document of a shard.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logtrail.llm.byte_text import mix

#: Ids, and documents, that a shard has at most, but for one document alone.
SHARD_IDS, SHARD_DOCS = 1 << 25, 1 << 20
#: Keys of a bucket of the index, about.
BUCKET_KEYS = 500_000
#: Bits per key of a level of the hash.
LOOSE = 2
#: Words whose ids a worker remembers.
WORDS = 600_000
#: Texts that are encoded at once.
TEXTS = 100
#: Words that are looked up at once; bytes of ids, and documents, that are read at once.
STEP, READ_BYTES, READ_DOCS = 100_000, 8 << 20, 4096
#: Keys of one bucket from which on its file is read whole.
MANY = 200

_MAGIC = b"IDSHARD1"
_SHARD_TAIL = "<QQQ8s"
_INDEX_TAIL = "<QQQQ8s"
_ODD_SPACES = re.compile("[\x1c-\x1f]")
#: A sign that stands between words while they are encoded; words that hold it are encoded by themselves.
_MARK = "\x01"
#: A letter or digit, then signs; an apostrophe may begin a piece with the letters behind it.
_SIGNS_LAST = re.compile(r"(.*[^\W_])([!-&(-/:-@\[-`{-~]+)", re.DOTALL)

CATALOG = "shard bigint, file string, key bigint, first bigint, count bigint, ids bigint"
SHARDS = "shard bigint, file string, docs bigint, unkeyed bigint, ids bigint, base bigint"
BUCKETS = "bucket bigint, buckets bigint, file string, keys bigint"


# Encoding ------------------------------------------------------------------


class WordEncoder:
    """Ids of texts as bytes, from ids of their words."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        whole, parts = self._ids(["one two\n, three"])[0], self._ids(["one", "two", ",", "three"])
        if whole != [i for part in parts for i in part]:
            raise ValueError("the tokenizer has pieces that hold white space")
        self.dtype = "<u2" if self._tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"
        if self._ids(["AB.x"]) != self._ids(["ab.x"]):
            raise ValueError("the tokenizer tells capital letters apart")
        (self._mark,) = self._ids([_MARK])[0]
        self._known: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, text: str) -> bytes:
        """The ids of a whole text."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, new words of all texts encoded together."""
        words = [re.split("[ \t-\r]+", text) if _ODD_SPACES.search(text) else text.split() for text in texts]
        known = self._known
        if sum(map(len, words)) <= STEP:
            self._learn({w for some in words for w in some if w not in known}, (w for some in words for w in some))
            return [b"".join(map(known.__getitem__, some)) for some in words]
        return [self._encode_long(some) for some in words]

    def _encode_long(self, words: list[str]) -> bytes:
        parts: list[bytes] = []
        for at in range(0, len(words), STEP):
            some = words[at : at + STEP]
            self._learn({w for w in some if w not in self._known}, some)
            parts += map(self._known.__getitem__, some)
        return b"".join(parts)

    def _learn(self, new: set[str], needed: Iterable[str] = ()) -> None:
        """Remember the ids of words; where there would be too many, only these and the ``needed`` ones."""
        known = self._known
        if len(known) + len(new) > WORDS:
            kept = {w: known[w] for w in needed if w in known}
            known.clear()
            known.update(kept)
        pieces = {w: _pieces(w) for w in new}
        fresh = {p for some in pieces.values() for p in some if p not in known}
        marked = [p for p in fresh if _MARK in p]
        known.update((p, np.array(ids, self.dtype).tobytes()) for p, ids in zip(marked, self._ids(marked), strict=True))
        plain = [p for p in fresh if _MARK not in p]
        # Words between marks, as one text: the library then works on it in one go.
        ids = np.array(self._ids([f" {_MARK} ".join(["", *plain])])[0], self.dtype)
        payload, width = ids.tobytes(), ids.itemsize
        ends = [*(np.flatnonzero(ids == self._mark) * width).tolist(), len(payload)]
        known.update((p, payload[a + width : b]) for p, a, b in zip(plain, ends[:-1], ends[1:], strict=True))
        known.update((w, b"".join([known[p] for p in some])) for w, some in pieces.items() if len(some) > 1 or some[0] != w)


def _pieces(word: str) -> tuple[str, ...]:
    """Parts of a word that the tokenizer takes apart in any case: ASCII signs at its end; small letters where it is all ASCII."""
    if "<|" in word:
        return (word,)
    if word.isascii():
        word = word.lower()
    parted = _SIGNS_LAST.fullmatch(word)
    return (word,) if parted is None else parted.groups()


_encoders: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    """One encoder per worker process and tokenizer, with the words it has met."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


# Files ---------------------------------------------------------------------


def _open(place: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(place)


def _tail(source: pa.NativeFile, layout: str) -> tuple:
    """The numbers at the end of a file."""
    size = struct.calcsize(layout)
    return struct.unpack(layout, source.read_at(size, source.size() - size))


class _Shard:
    """A shard that is being written."""

    def __init__(self, place: str, number: int, dtype: str):
        system, root = _open(place)
        self.number, self.dtype = number, np.dtype(dtype)
        self.file = f"shard-{number:014d}-{uuid.uuid4().hex}.ids"
        system.create_dir(f"{root}/shards", recursive=True)
        self._stream = system.open_output_stream(f"{root}/shards/{self.file}")
        self.keys: list[int | None] = []
        self.starts = [0]

    def add(self, key: int | None, ids: bytes) -> None:
        self._stream.write(ids)
        self.keys.append(key)
        self.starts.append(self.starts[-1] + len(ids) // self.dtype.itemsize)

    def full(self) -> bool:
        return self.starts[-1] >= SHARD_IDS or len(self.keys) >= SHARD_DOCS

    def close(self) -> pa.RecordBatch:
        """Finish the file; one catalog row per run of equal keys."""
        unkeyed = sum(1 for k in self.keys if k is None)
        keys = np.array([0 if k is None else k for k in self.keys], np.int64)
        starts = np.array(self.starts, np.int64)
        self._stream.write(keys.tobytes())
        self._stream.write(starts.tobytes())
        self._stream.write(struct.pack(_SHARD_TAIL, len(keys), unkeyed, self.dtype.itemsize, _MAGIC))
        self._stream.close()
        null = np.arange(len(keys)) < unkeyed
        first = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]) | (null[1:] != null[:-1]))))
        ends = np.append(first[1:], len(keys))
        columns = [
            pa.repeat(self.number, len(first)),
            pa.repeat(self.file, len(first)),
            pa.array(keys[first], mask=null[first]),
            pa.array(first),
            pa.array(ends - first),
            pa.array(starts[ends] - starts[first]),
        ]
        return pa.RecordBatch.from_arrays(columns, ["shard", "file", "key", "first", "count", "ids"])


class _Places:
    """An array in an open file, of which single elements are read."""

    def __init__(self, source: pa.NativeFile, at: int, dtype: str, size: int):
        self._source, self._at, self._dtype, self._size = source, at, np.dtype(dtype), size

    def __getitem__(self, places: np.ndarray) -> np.ndarray:
        width = self._dtype.itemsize
        parts = [self._source.read_at(width, self._at + int(i) * width) for i in places]
        return np.frombuffer(b"".join(parts), self._dtype)

    def whole(self) -> np.ndarray:
        return np.frombuffer(self._source.read_at(self._size * self._dtype.itemsize, self._at), self._dtype)


# The hash ------------------------------------------------------------------


def _level_hash(keys: np.ndarray, level: int) -> np.ndarray:
    return mix(keys.view(np.uint64) + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))


def fingerprints(keys: np.ndarray) -> np.ndarray:
    """32 bits that tell most keys apart, independent of their slots."""
    return (mix(keys.view(np.uint64) ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(32)).astype("<u4")


def build_hash(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bits of all levels as 64-bit words, and the bits of each level, for distinct int64 keys."""
    words, sizes = [], []
    left = keys
    while len(left):
        size = -(-max(LOOSE * len(left), 64) // 64) * 64
        place = (_level_hash(left, len(sizes)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(place, minlength=size) == 1
        words.append(np.packbits(alone, bitorder="little").view("<u8"))
        sizes.append(size)
        left = left[~alone[place]]
    return np.concatenate(words) if words else np.zeros(0, "<u8"), np.array(sizes, np.int64)


def slots(keys: np.ndarray, words, before, sizes: np.ndarray) -> np.ndarray:
    """The slot of each key, -1 for keys that have none; ``words`` and ``before`` may lie in a file."""
    out = np.full(len(keys), -1, np.int64)
    left, base = np.arange(len(keys)), 0
    for level, size in enumerate(sizes):
        if not len(left):
            break
        place = (_level_hash(keys[left], level) % np.uint64(size)).astype(np.int64) + base
        word = words[place >> 6]
        bit = (place & 63).astype(np.uint64)
        hit = (word >> bit) & np.uint64(1) == 1
        below = np.bitwise_count(word[hit] & ((np.uint64(1) << bit[hit]) - np.uint64(1)))
        out[left[hit]] = before[place[hit] >> 6].astype(np.int64) + below
        left, base = left[~hit], base + int(size)
    return out


# Writing -------------------------------------------------------------------


def write(docs: DataFrame, place: str, tokenizer: str, end_id: int = 1, key: str = "doc_id", text: str = "text") -> None:
    """Encode documents into shards below ``place``, and index them by key.

    ``tokenizer`` is a file of the tokenizers library that workers can open.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    order = [F.asc_nulls_first("key"), F.xxhash64("text")]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        end = np.array([end_id], encoder.dtype).tobytes()
        part, number, shard = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                some = batch.slice(at, TEXTS)
                for k, ids in zip(some.column(0).to_pylist(), encoder.encode_all(some.column(1).to_pylist()), strict=True):
                    if shard is None:
                        shard = _Shard(place, (part << 20) + number, encoder.dtype)
                    shard.add(k, ids + end)
                    if shard.full():
                        yield shard.close()
                        shard, number = None, number + 1
        if shard is not None:
            yield shard.close()

    placed.mapInArrow(run, CATALOG).write.parquet(f"{place}/catalog")
    catalog = spark.read.schema(CATALOG).parquet(f"{place}/catalog")
    _write_shard_table(catalog, place)
    _write_index(catalog, place)


def _write_shard_table(catalog: DataFrame, place: str) -> None:
    """The shards with the number of ids before each: sums within a task's shards, then over tasks."""
    unkeyed = F.sum(F.when(F.col("key").isNull(), F.col("count")).otherwise(0))
    shards = catalog.groupBy("shard", "file").agg(F.sum("count").alias("docs"), unkeyed.alias("unkeyed"), F.sum("ids").alias("ids"))
    shards = shards.withColumn("task", F.shiftright("shard", 20))
    up_to = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = shards.groupBy("task").agg(F.sum("ids").alias("all")).select("task", F.coalesce(F.sum("all").over(up_to), F.lit(0)).alias("tasks_before"))
    within = F.sum("ids").over(Window.partitionBy("task").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    based = shards.withColumn("within", F.coalesce(within, F.lit(0))).join(tasks, "task")
    based.select("shard", "file", "docs", "unkeyed", "ids", (F.col("tasks_before") + F.col("within")).alias("base")).write.parquet(f"{place}/shard-table")


def _write_index(catalog: DataFrame, place: str) -> None:
    entries = catalog.where("key is not null")
    buckets = entries.count() // BUCKET_KEYS + 1

    def build(table: pa.Table) -> pa.Table:
        system, root = _open(place)
        system.create_dir(f"{root}/index", recursive=True)
        bucket = table.column("bucket")[0].as_py()
        file = f"bucket-{bucket:010d}-{uuid.uuid4().hex}.mph"
        key, shard, first, count = (np.asarray(table.column(c)) for c in ("key", "shard", "first", "count"))
        keys = np.unique(key)
        words, sizes = build_hash(keys)
        before = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)))[:-1].astype("<u4")
        slot = slots(keys, words, before, sizes)
        # Places in order of slot, then shard.
        of_entry = slot[np.searchsorted(keys, key)]
        order = np.lexsort((shard, of_entry))
        begins = np.searchsorted(of_entry[order], np.arange(len(keys) + 1)).astype("<u4")
        prints = np.zeros(len(keys), "<u4")
        prints[slot] = fingerprints(keys)
        with system.open_output_stream(f"{root}/index/{file}") as stream:
            for part in (words, before, prints, begins, np.stack((shard, first, count), 1)[order].astype("<i8"), sizes.astype("<i8")):
                stream.write(np.ascontiguousarray(part).tobytes())
            stream.write(struct.pack(_INDEX_TAIL, len(words), len(keys), len(key), len(sizes), _MAGIC))
        return pa.table({"bucket": [bucket], "buckets": [buckets], "file": [file], "keys": [len(keys)]})

    dealt = entries.select(_bucket(F.col("key"), buckets).alias("bucket"), "key", "shard", "first", "count")
    dealt.groupBy("bucket").applyInArrow(build, BUCKETS).write.parquet(f"{place}/bucket-table")


def _bucket(key, buckets: int):
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("bigint")


class Index:
    """The file of one bucket."""

    def __init__(self, place: str, file: str, whole: bool):
        system, root = _open(place)
        source = self._source = system.open_input_file(f"{root}/index/{file}")
        n_words, n_keys, n_entries, n_levels, magic = _tail(source, _INDEX_TAIL)
        if magic != _MAGIC:
            raise ValueError(f"not an index: {file}")
        parts, at = [], 0
        for dtype, size in (("<u8", n_words), ("<u4", n_words), ("<u4", n_keys), ("<u4", n_keys + 1), ("<i8", 3 * n_entries), ("<i8", n_levels)):
            parts.append(_Places(source, at, dtype, size))
            at += size * np.dtype(dtype).itemsize
        self._sizes = parts.pop().whole()
        self._words, self._before, self._prints, self._begins, self._entries = [p.whole() for p in parts] if whole else parts

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each place of a key: the number of the key, and (shard, first document, documents)."""
        slot = slots(keys, self._words, self._before, self._sizes)
        there = np.flatnonzero(slot >= 0)
        there = there[self._prints[slot[there]] == fingerprints(keys[there])]
        begins, ends = (self._begins[slot[there] + k].astype(np.int64) for k in (0, 1))
        of_key = np.repeat(there, ends - begins)
        rows = np.arange(len(of_key)) - np.repeat(np.cumsum(ends - begins) - ends, ends - begins)
        return of_key, self._entries[(3 * rows[:, None] + np.arange(3)).ravel()].reshape(-1, 3)

    def close(self) -> None:
        self._source.close()


# Reading -------------------------------------------------------------------


def shards(spark: SparkSession, place: str) -> DataFrame:
    """The shards: number, file, documents, documents without key, ids, ids before it."""
    return spark.read.schema(SHARDS).parquet(f"{place}/shard-table")


def read(spark: SparkSession, place: str, keys: DataFrame, unkeyed: bool = False) -> DataFrame:
    """``doc_id, start, ids`` of every document with one of the ``keys``, looked up in the index.

    ``start`` counts the ids of all documents before it, ``ids`` are
    little-endian 32-bit integers with the end id. With ``unkeyed``, documents
    without a key come as well.
    """
    table = spark.read.schema(BUCKETS).parquet(f"{place}/bucket-table")
    one = table.select("buckets").first()
    key = F.col(keys.columns[0]).cast("bigint").alias("key")
    wanted = keys.select(key).where("key is not null").distinct()
    files = table.select("bucket", "file")
    asked = wanted.withColumn("bucket", _bucket(F.col("key"), one[0] if one else 1)).join(files, "bucket")

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, some in _by_file(batches):
            numbers = np.asarray(some.column("key"))
            index = Index(place, file, len(numbers) >= MANY)
            of_key, entry = index.find(numbers)
            index.close()
            yield pa.RecordBatch.from_arrays([pa.array(numbers[of_key]), *[pa.array(np.ascontiguousarray(c)) for c in entry.T]], ["key", "shard", "first", "count"])

    at = asked.repartition("bucket").sortWithinPartitions("bucket").select("file", "key").mapInArrow(look_up, "key bigint, shard bigint, first bigint, count bigint")
    table = shards(spark, place)
    found = at.join(table.select("shard", "file", "base"), "shard").select("shard", "file", "base", "key", "first", "count")
    if unkeyed:
        every = table.where("unkeyed > 0").select("shard", "file", "base", F.lit(None).cast("bigint").alias("key"), F.lit(0).cast("bigint").alias("first"), F.col("unkeyed").alias("count"))
        found = found.unionByName(every)

    def payloads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, some in _by_file(batches):
            yield from _documents(place, file, some)

    return found.repartition("shard").sortWithinPartitions("shard", "first").drop("shard").mapInArrow(payloads, "doc_id bigint, start bigint, ids binary")


def _by_file(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.RecordBatch]]:
    """Parts of batches that ask for one file."""
    for batch in batches:
        names = batch.column("file").dictionary_encode()
        codes = np.asarray(names.indices)
        edges = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1], [True]))) if len(codes) else codes
        for begin, end in zip(edges[:-1], edges[1:], strict=True):
            yield names.dictionary[int(codes[begin])].as_py(), batch.slice(begin, end - begin)


def _documents(place: str, file: str, asked: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The documents that some rows name, neighbours in one read."""
    system, root = _open(place)
    with system.open_input_file(f"{root}/shards/{file}") as source:
        docs, unkeyed, width, magic = _tail(source, _SHARD_TAIL)
        if magic != _MAGIC:
            raise ValueError(f"not a shard: {file}")
        at = source.size() - struct.calcsize(_SHARD_TAIL) - 8 * (docs + 1)
        starts, keys = _Places(source, at, "<i8", docs + 1), _Places(source, at - 8 * docs, "<i8", docs)
        key, first, count = (np.asarray(asked.column(c).fill_null(0)) for c in ("key", "first", "count"))
        base = asked.column("base")[0].as_py()
        number = np.repeat(first, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        if len(number) >= MANY:
            starts, keys = starts.whole(), keys.whole()
        # The key in the shard decides: a fingerprint may be another key's.
        good = (number < unkeyed) == np.repeat(np.asarray(asked.column("key").is_null()), count)
        number = number[good & ((keys[number] == np.repeat(key, count)) | (number < unkeyed))]
        begins, ends = starts[number], starts[number + 1]
        at = 0
        while at < len(number):
            # Neighbours up to READ_BYTES, or one document.
            near = slice(at, at + READ_DOCS)
            together = (np.diff(number[near]) == 1) & ((ends[near][1:] - begins[at]) * width <= READ_BYTES)
            end = at + 1 + int(np.argmin(together) if len(together) and not together.all() else len(together))
            ids = np.frombuffer(source.read_at(int(ends[end - 1] - begins[at]) * width, int(begins[at]) * width), f"<u{width}").astype("<u4")
            cuts = np.append(begins[at:end], ends[end - 1]) - begins[at]
            payload = pa.Array.from_buffers(pa.large_binary(), end - at, [None, pa.py_buffer(cuts.astype(np.int64) * 4), pa.py_buffer(ids)]).cast(pa.binary())
            none = number[at:end] < unkeyed
            yield pa.RecordBatch.from_arrays([pa.array(keys[number[at:end]], mask=none), pa.array(begins[at:end] + base), payload], ["doc_id", "start", "ids"])
            at = end
