"""What a task holds at a time, and what its process keeps afterwards."""

import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F

from logtrail.llm import byte_bpe
from logtrail.session import configure


def test_batches_of_long_texts_are_bounded_by_bytes(spark):
    docs = configure(spark).range(0, 6000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("text "), 1000).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["n", "size"])

    found = docs.mapInArrow(sizes, "n bigint, size bigint").collect()
    assert sum(r["n"] for r in found) == 6000
    assert max(r["size"] for r in found) < 8 << 20


def test_a_process_keeps_no_pieces_after_a_task(spark):
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    docs = spark.range(0, 2000, 1, 4).select(F.col("id").alias("doc_id"), F.concat(F.lit("a"), F.sha2(F.col("id").cast("string"), 256)).alias("text"))
    encoded = byte_bpe.encode_checked(docs, path, pattern).select("doc_id", F.size("token_ids").alias("n"))
    told = byte_bpe.digests(docs, path, pattern).select("doc_id", "n_tokens")
    assert {(r["doc_id"], r["n"]) for r in encoded.collect()} == {(r["doc_id"], r["n_tokens"]) for r in told.collect()}

    def kept(batches):
        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(byte_bpe.encoder(path, pattern)._known)])], ["n"])

    assert sum(r["n"] for r in spark.range(0, 64, 1, 16).mapInArrow(kept, "n bigint").collect()) == 0
