"""The time clamp on a stream of plain facts: T1, T3."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from logtrail.operators.filters import clamp_to_log
from logtrail import files


def stream_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table, one file or a folder, as a file stream."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files.is_file(spark, path):
        folder, _, name = path.rpartition("/")
        return reader.option("pathGlobFilter", name).parquet(folder)
    return reader.parquet(path)


def clamp_stream(stream: DataFrame, logs: DataFrame, out: str, shape: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Clamp all that a stream holds now, batch by batch, and read the result.

    A batch that runs again after a failure overwrites its own folder.
    """

    def write(batch: DataFrame, number: int) -> None:
        clamp_to_log(shape(batch), logs).write.mode("overwrite").parquet(f"{out}/rows/batch={number}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{out}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.parquet(f"{out}/rows").drop("batch")
