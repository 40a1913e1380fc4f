"""The operators of this package on whole tables, each with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logtrail.llm import bit_sliced, byte_bpe, decontaminate, divergence, jaccard_rtree, periodic_runs, pseudonyms, quality_votes, repeats, token_shards, toxicity, url_model, warc_bundles
from logtrail.llm import sql_checks as sql
from logtrail.session import configure, scratch_path

#: The key of the pseudonyms in queries; real use gives its own secret.
EXAMPLE_KEY = b"an example key, not a secret"


@dataclass(frozen=True)
class Query:
    """A query over a folder of tables, and its SQL where there is one."""

    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(text: str | None = None) -> Callable:
    def register(run: Callable[[SparkSession, str], DataFrame]) -> Callable:
        @wraps(run)
        def configured(spark: SparkSession, folder: str) -> DataFrame:
            return run(configure(spark), folder)

        QUERIES[run.__name__] = Query(configured, text)
        return configured

    return register


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def bpe_files() -> tuple[str, str]:
    """Ranks and pattern of the public byte-level tokenizer."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@query(sql.URLS)
def op1_url_language_model(spark: SparkSession, folder: str) -> DataFrame:
    """Rule or language-model verdict of every page's url."""
    return url_model.judge(read(spark, folder, "pages")).select("page_id", "host", "path", "rule", "verdict")


@query()
def op4_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of the token ids, and of the decoded bytes, of every document."""
    return byte_bpe.digests(read(spark, folder, "documents"), *bpe_files())


@query()
def op6_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with pseudonyms for its personal data."""
    documents = read(spark, folder, "documents").select("doc_id", "text")
    return pseudonyms.pseudonymise_column(documents, EXAMPLE_KEY)


@query(sql.WARC)
def op8_warc_bundles(spark: SparkSession, folder: str) -> DataFrame:
    """Pages written as WARC bundles and read back: size, digest and kind of each record."""
    place = scratch_path(spark, "warc")
    warc_bundles.write_bundles(read(spark, folder, "pages"), place)
    return warc_bundles.read_records(spark, place).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query(sql.TOP_K)
def op7_bit_sliced_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """The five best rows by inner product for every fiftieth vector."""
    rows = read(spark, folder, "embeddings").where(F.col("vec_id").isNotNull() & bit_sliced.usable(F.col("embedding")))
    vectors = rows.select(F.col("vec_id").alias("id"), bit_sliced.quantised(F.col("embedding")).alias("numbers"))
    # Of rows that share an id, the smallest vector asks.
    queries = vectors.where(F.col("id") % 50 == 0).groupBy("id").agg(F.min("numbers").alias("numbers"))
    return bit_sliced.top_k(vectors, queries, 5)


@query()
def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document, learnt from labelled documents outside the held-out third."""
    documents, labels = read(spark, folder, "documents"), read(spark, folder, "labels")
    held_out = toxicity.fold(3, 1)
    model = toxicity.train(documents, labels, held_out)
    scored = toxicity.score(documents.select("doc_id", "text"), model, into="score")
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


@query(sql.JACCARD)
def op9_jaccard_rtree(spark: SparkSession, folder: str) -> DataFrame:
    """Component of every document under a Jaccard similarity of 0.9 of three-word shingles."""
    return jaccard_rtree.near_duplicates(read(spark, folder, "documents"), 3, 90)


@query()
def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark items in documents, with the edits of the best alignment."""
    return decontaminate.matches(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


@query()
def op3_suffix_repeats(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the strings of 400 bytes that occur again."""
    return repeats.without_repeats(read(spark, folder, "documents"), 400)


@query()
def op5_quality_votes(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document, learnt from labelled documents outside the held-out fifth."""
    documents, labels = read(spark, folder, "documents"), read(spark, folder, "labels")
    held_out = toxicity.fold(5, 0)
    voters = quality_votes.train(documents, labels, held_out)
    scored = quality_votes.score(documents.select("doc_id", "text"), voters, into="score")
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= quality_votes.THRESHOLD).cast("int").alias("predicted"))


def word_bpe_file() -> str:
    """The public tokenizer with word ends."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query()
def op11_token_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's ids written to binary shards and read back by its key: place, number and checksum."""
    documents, place = read(spark, folder, "documents"), scratch_path(spark, "token-shards")
    token_shards.write(documents, place, word_bpe_file())
    found = token_shards.read(spark, place, documents.select("doc_id"), unkeyed=True)
    n_tokens = (F.octet_length("ids") / 4).cast("bigint")
    return found.select("doc_id", "start", n_tokens.alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


@query(sql.DIVERGENCE)
def op12_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    """How far sources of a language lie apart, and the terms that each has more of than its language."""
    return divergence.audit(read(spark, folder, "documents"))


def with_periodic_tails(documents: DataFrame) -> DataFrame:
    """``doc_id, text``; of documents whose number's checksum ends in 0, the words from a place on repeat a stretch of them.

    Without a doc_id, or without words, a text stays as it is.
    """
    code = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    hit = documents.select("doc_id", "text", F.floor(code / 10).alias("g"), F.when(code % 10 == 0, words).alias("words"))
    sized = hit.select("*", F.nullif(F.size("words"), F.lit(0)).alias("n")).select("*", (F.col("g") % F.col("n")).cast("int").alias("a"))
    stretch = sized.select("*", (F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)) + 1).cast("int").alias("p"))
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    tail = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), times))
    made = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(tail, F.lit(1), F.col("n") - F.col("a"))), " ")
    return stretch.select("doc_id", F.coalesce(F.when(F.col("n").isNotNull(), made), "text").alias("text"))


@query()
def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """The longest run of every document, digests of all its runs and of its text without what they repeat."""
    found = periodic_runs.collapse(with_periodic_tails(read(spark, folder, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    best = found.select("doc_id", "runs", longest.alias("longest"), listed.alias("listed"), "collapsed")
    length, period = F.col("longest.length"), -F.col("longest.period")
    return best.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("longest.start")).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).cast("bigint").alias("exponent_milli"),
        F.sha2(F.col("listed").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


@query()
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """Documents through all stages of the corpus pipeline."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)
