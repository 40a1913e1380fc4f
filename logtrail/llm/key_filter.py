"""A bitmap of hashed keys of fixed size, to leave rows out before they are shuffled.

It never leaves out a wanted row; with more keys than bits it only lets more
through. A join that follows decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of the bitmap (4 MB), a power of two.
BITS = 1 << 25
#: Words of 64 bits that are put into one row.
RUN = 1 << 12


def bitmap(keys: DataFrame) -> Broadcast:
    """The bits of the one bigint column of ``keys``, which must be hashes already."""
    key = F.col(keys.columns[0])
    place = F.pmod(F.shiftright(key, 6), F.lit(BITS // 64)).alias("place")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(key, F.lit(64)).cast("int")).alias("bit")
    words = keys.select(place, bit).groupBy("place").agg(F.bit_or("bit").alias("bit"))

    def pack(table: pa.Table) -> pa.Table:
        place = np.asarray(table.column("place"))
        run = np.zeros(RUN, np.int64)
        run[place % RUN] = np.asarray(table.column("bit"))
        return pa.table({"run": pa.array([int(place[0]) // RUN], pa.int64()), "bits": pa.array([run.tobytes()], pa.binary())})

    # At most BITS / 64 / RUN rows of 8 * RUN bytes come to the driver, however many keys there are.
    packed = words.withColumn("run", F.floor(F.col("place") / RUN)).groupBy("run").applyInArrow(pack, "run bigint, bits binary")
    out = np.zeros((BITS // 64 // RUN, RUN), np.int64)
    for row in packed.collect():
        out[row["run"]] = np.frombuffer(row["bits"], np.int64)
    return keys.sparkSession.sparkContext.broadcast(out.ravel().view(np.uint64))


def may_hold(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each int64 key may be among those of the bitmap."""
    return (bits[(keys >> 6) % (BITS // 64)] >> (keys % 64).astype(np.uint64)) & np.uint64(1) == 1


def among(rows: DataFrame, key: str, bits: Broadcast) -> DataFrame:
    """The rows whose bigint column ``key`` may be among the keys of a bitmap."""
    place = rows.columns.index(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(may_hold(bits.value, np.asarray(batch.column(place)))))

    return rows.mapInArrow(run, rows.schema)
