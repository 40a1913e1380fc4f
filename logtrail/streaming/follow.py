"""A folder followed as a stream of log files: T1–T3.

Every micro-batch is an ordinary merge. The checkpoint keeps a file from being
read twice; the ledger keeps a log from being merged twice, also when a batch
is run again after a crash. The time clamp inside the merge is a bound per log
and not a watermark, so no streaming state grows.
"""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logtrail import fixed_values as fixed
from logtrail.files import is_mounted
from logtrail.plans.merge import MergeOptions, merge
from logtrail.plans.store import LogStore
from logtrail.sources.log_files import VALUE_LIMIT, with_content


def stream_log_files(
    store: LogStore, folder: str, files_per_batch: int = 1000, archive_to: str | None = None
) -> DataFrame:
    """New log files under a folder as a stream of ``(path, content)``.

    Content as in ``read_log_files``. From a store that workers do not mount, a
    file that does not fit one value stops a stream that archives its inputs,
    rather than being archived unread; else its merge reports it.
    """

    def listed() -> DataFrame:
        reader = (
            store.spark.readStream.format("binaryFile")
            .option("pathGlobFilter", fixed.LOG_FILE_GLOB)
            .option("recursiveFileLookup", "true")
            .option("maxFilesPerTrigger", str(files_per_batch))
        )
        if archive_to:
            reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_to)
        schema = "path string, modificationTime timestamp, length bigint, content binary"
        return reader.schema(schema).load(folder)

    if is_mounted(store.spark, folder):
        return with_content(listed(), mounted=True)
    if archive_to:
        return listed().select("path", "content")
    small = listed().where(f"length <= {VALUE_LIMIT}").select("path", "content")
    large = listed().where(f"length > {VALUE_LIMIT}").select("path", F.lit(None).cast("binary").alias("content"))
    return small.unionByName(large)


def follow(
    store: LogStore,
    folder: str,
    checkpoint: str,
    options: MergeOptions | None = None,
    every_seconds: int | None = None,
    files_per_batch: int = 1000,
    archive_to: str | None = None,
) -> StreamingQuery:
    """Merge new files of a folder, every so many seconds or once until none is left."""
    if every_seconds is not None and every_seconds <= 0:
        raise ValueError("every_seconds must be positive")
    stream = stream_log_files(store, folder, files_per_batch, archive_to)
    options = options or MergeOptions()
    if options.input_root is None:
        options = replace(options, input_root=folder)
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, number: merge(store, batch, options, batch_id=f"stream-{number}-{uuid.uuid4().hex[:8]}")
    )
    if every_seconds is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{every_seconds} seconds").start()
