"""WARC records in seekable Zstandard bundles, written and read back.

Pages become WARC 1.1 records. Records are grouped into independent Zstandard
frames, frames into bundles, and each bundle ends with a seek table in a
skippable frame, so one record can be read by decompressing one frame. The
index maps a record to its bundle, frame and offset in the frame. Of records
with equal payloads of at least ``revisit_from`` bytes, the one with the
largest page_id is the response, and the others are revisits without payload.

A null html is an empty payload. Rows with a null page_id revisit the largest
page_id with that payload; where there is none, they are responses. Rows that
share the largest page_id are all responses. A null or unprintable url becomes
a target that names the page. A record larger than a frame has its own frame,
so no payload is cut.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logtrail.session import configure, scratch_path

#: Bytes of records in one frame, and of frames in one bundle, after which the next begins.
FRAME_BYTES, BUNDLE_BYTES = 256 << 10, 8 << 20
#: The table has no time of capture.
DATE = "1970-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

# Fixed values of the seekable format: magic of a skippable frame, magic of the footer.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1

BUNDLE_SCHEMA = "bundle string, data binary, records array<struct<record_id:string,frame:int,offset:int,length:int>>"
_RECORDS = pa.list_(pa.struct([("record_id", pa.string()), ("frame", pa.int32()), ("offset", pa.int32()), ("length", pa.int32())]))


def record_id(page_id: int | None) -> str:
    return f"urn:page:{'' if page_id is None else page_id}"


def payload_digest(payload: bytes) -> str:
    """Upper-case base32 of SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record; a revisit where it refers to another page."""
    target = quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url else record_id(page_id)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{record_id(page_id)}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
    ]
    if refers_to is None:
        block = HTTP + payload
    else:
        block = b""
        head += [
            f"WARC-Refers-To: <{record_id(refers_to)}>",
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"X-Payload-Length: {len(payload)}",
        ]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes, begin: int) -> tuple[dict[str, str], bytes, int]:
    """Header fields, block, and where the record ends."""
    end = data.index(b"\r\n\r\n", begin)
    version, *lines = data[begin:end].decode().split("\r\n")
    if version != "WARC/1.1":
        raise ValueError(f"no record at byte {begin}")
    fields = dict(line.split(": ", 1) for line in lines)
    begin, end = end + 4, end + 4 + int(fields["Content-Length"])
    if data[end : end + 4] != b"\r\n\r\n":
        raise ValueError("record is cut")
    return fields, data[begin:end], end + 4


class BundleWriter:
    """Collects records into frames and frames into one bundle."""

    def __init__(self):
        self._compressor = zstandard.ZstdCompressor(level=3)
        self._frames: list[tuple[bytes, int]] = []
        self._open = bytearray()
        self.records: list[dict] = []
        self.size = 0

    def add(self, name: str, record: bytes) -> None:
        if self._open and len(self._open) + len(record) > FRAME_BYTES:
            self._close_frame()
        self.records.append({"record_id": name, "frame": len(self._frames), "offset": len(self._open), "length": len(record)})
        self._open += record

    def _close_frame(self) -> None:
        packed = self._compressor.compress(bytes(self._open))
        self._frames.append((packed, len(self._open)))
        self.size += len(packed)
        self._open = bytearray()

    def finish(self) -> bytes:
        """All frames and the seek table."""
        if self._open:
            self._close_frame()
        table = b"".join(struct.pack("<II", len(packed), plain) for packed, plain in self._frames)
        footer = table + struct.pack("<IBI", len(self._frames), 0, SEEKABLE)
        return b"".join(packed for packed, _ in self._frames) + struct.pack("<II", SKIPPABLE, len(footer)) + footer


def seek_table(bundle: bytes) -> list[tuple[int, int, int]]:
    """Offset, compressed and plain size of each frame, from the end of the bundle."""
    count, _, magic = struct.unpack("<IBI", bundle[-9:])
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    begin, out = len(bundle) - 9 - 8 * count, []
    offset = 0
    for packed, plain in struct.iter_unpack("<II", bundle[begin : len(bundle) - 9]):
        out.append((offset, packed, plain))
        offset += packed
    return out


def read_frame(bundle: bytes, entry: tuple[int, int, int]) -> bytes:
    offset, packed, plain = entry
    return zstandard.ZstdDecompressor().decompress(bundle[offset : offset + packed], max_output_size=max(plain, 1))


def with_references(pages: DataFrame, revisit_from: int = 0) -> DataFrame:
    """page_id, url, html, and the page that a revisit refers to."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("_key", F.sha1(F.col("html").cast("binary")))
    place = scratch_path(pages.sparkSession, "warc-payloads")
    # Written so that both sides of the join are plain shuffles, which can be split where a payload is hot.
    rows.groupBy("_key").agg(F.max("page_id").alias("_last")).write.parquet(place)
    last = pages.sparkSession.read.parquet(place)
    joined = rows.join(last, "_key")
    revisit = (F.octet_length("html") >= revisit_from) & (F.coalesce(F.col("page_id") != F.col("_last"), F.col("_last").isNotNull()))
    return joined.select("page_id", "url", "html", F.when(revisit, F.col("_last")).alias("refers_to"))


def bundles(pages: DataFrame, revisit_from: int = 0) -> DataFrame:
    """Bundles of all pages: name, bytes, and index of records."""
    configure(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, writer = TaskContext.get().partitionId(), 0, BundleWriter()

        def close() -> pa.RecordBatch:
            data = writer.finish()
            return pa.RecordBatch.from_arrays(
                [pa.array([f"{part:06d}-{number:06d}.warc.zst"]), pa.array([data], pa.binary()), pa.array([writer.records], _RECORDS)],
                ["bundle", "data", "records"],
            )

        for batch in batches:
            for page_id, url, html, refers_to in zip(*(c for c in batch.columns), strict=True):
                page = page_id.as_py()
                writer.add(record_id(page), record_bytes(page, url.as_py(), html.as_py().encode(), refers_to.as_py()))
                if writer.size >= BUNDLE_BYTES:
                    yield close()
                    number, writer = number + 1, BundleWriter()
        if writer.records:
            yield close()

    return with_references(pages, revisit_from).mapInArrow(run, BUNDLE_SCHEMA)


def write_bundles(pages: DataFrame, path: str, revisit_from: int = 0) -> None:
    """Write the bundles to a folder, a row per bundle; they are compressed already."""
    bundles(pages, revisit_from).write.option("compression", "none").parquet(path)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the bundles of a folder, with its payload; a response's digest is checked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                bundle = data.as_py()
                for entry in seek_table(bundle):
                    yield pa.RecordBatch.from_pylist([_row(*r) for r in _records(read_frame(bundle, entry))], _READ)

    return spark.read.parquet(path).select("data").mapInArrow(
        run, "page_id bigint, url string, record_type string, refers_to bigint, payload_digest string, payload_bytes bigint, payload binary"
    )


_READ = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload_digest", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload", pa.binary()),
    ]
)


def _records(frame: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    at = 0
    while at < len(frame):
        fields, block, at = parse_record(frame, at)
        yield fields, block


def _number(name: str) -> int | None:
    digits = name.strip("<>").removeprefix("urn:page:")
    return int(digits) if digits else None


def _row(fields: dict[str, str], block: bytes) -> dict:
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    row = {"page_id": _number(fields["WARC-Record-ID"]), "url": fields["WARC-Target-URI"], "record_type": fields["WARC-Type"], "payload_digest": digest}
    if row["record_type"] == "revisit":
        return row | {"refers_to": _number(fields["WARC-Refers-To"]), "payload_bytes": int(fields["X-Payload-Length"]), "payload": None}
    payload = block[block.index(b"\r\n\r\n") + 4 :]
    if payload_digest(payload) != digest:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} is damaged")
    return row | {"refers_to": None, "payload_bytes": len(payload), "payload": payload}


def fetch(spark: SparkSession, path: str, record_ids: DataFrame) -> DataFrame:
    """record_id and raw record of the wanted ids; only the frames that hold them are decompressed."""
    stored = spark.read.parquet(path)
    wanted = stored.select("bundle", F.explode("records").alias("r")).select("bundle", "r.*").join(record_ids.select("record_id").distinct(), "record_id")
    by_bundle = wanted.groupBy("bundle").agg(F.collect_list(F.struct("record_id", "frame", "offset", "length")).alias("wanted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, want in zip(batch.column(0), batch.column(1), strict=True):
                bundle, rows, frames = data.as_py(), [], {}
                table = seek_table(bundle)
                for w in want.as_py():
                    frame = frames.setdefault(w["frame"], None) or read_frame(bundle, table[w["frame"]])
                    frames[w["frame"]] = frame
                    rows.append({"record_id": w["record_id"], "record": frame[w["offset"] : w["offset"] + w["length"]]})
                yield pa.RecordBatch.from_pylist(rows, pa.schema([("record_id", pa.string()), ("record", pa.binary())]))

    return stored.join(by_bundle, "bundle").select("data", "wanted").mapInArrow(run, "record_id string, record binary")
