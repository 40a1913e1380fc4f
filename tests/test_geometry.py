"""Point geometry against struct."""

import random
import struct

import sample_logs as sl
from pyspark.sql import functions as F

from logtrail.functions import geometry


def test_random_points_round_trip(spark):
    rng = random.Random(7)
    special = [0.0, -0.0, 1e-300, -179.9999999, 5e-324, 1.7976931348623157e308, 2.2250738585072014e-308, 100.663]
    values = special + [rng.uniform(-180, 180) for _ in range(500)]
    values += [struct.unpack("<d", rng.randbytes(8))[0] for _ in range(500)]
    values = [v for v in values if v == v and abs(v) != float("inf")]
    points = [(i, bytearray(sl.point(v, -v / 3))) for i, v in enumerate(values)]
    rows = spark.createDataFrame(points, "n int, geom binary")
    out = geometry.with_coordinates(rows, "geom").orderBy("n").collect()
    assert [struct.pack("<d", r.lon) for r in out] == [struct.pack("<d", v) for v in values]
    assert [struct.pack("<d", r.lat) for r in out] == [struct.pack("<d", -v / 3) for v in values]


def test_encodings_and_blobs_that_are_no_points(spark):
    xy = struct.pack("<dd", 100.5, 13.75)
    line = bytearray(sl.point(1.0, 2.0))
    line[39] = 2
    blobs = [sl.point(100.5, 13.75), bytes(line), b"", b"junk", None, sl.point(1.0, 2.0)[:59]]
    rows = spark.createDataFrame([(i, None if b is None else bytearray(b)) for i, b in enumerate(blobs)], "n int, geom binary")
    out = geometry.with_coordinates(rows, "geom").select(
        "lon", "lat", geometry.to_ewkb(F.col("geom")).alias("e"), geometry.to_mssql(F.col("geom")).alias("m"), "n"
    )
    first, *others = out.orderBy("n").collect()
    assert (first.lon, first.lat) == (100.5, 13.75)
    assert bytes(first.e) == bytes.fromhex("0101000020E6100000") + xy
    assert bytes(first.m) == bytes.fromhex("E6100000010C") + xy
    for row, blob in zip(others, blobs[1:], strict=True):
        assert row.lon is None and row.lat is None
        assert (row.e and bytes(row.e)) == (blob or row.e) and (row.m and bytes(row.m)) == (blob or row.m)
    again = spark.createDataFrame([(bytearray(first.e),)], "g binary").select(geometry.ewkb_to_mssql(F.col("g")).alias("m"))
    assert bytes(again.first().m) == bytes(first.m)
