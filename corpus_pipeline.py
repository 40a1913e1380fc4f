"""From raw documents to token ids: toxicity, near duplicates, benchmark passages, personal data, tokens.

Each stage takes the session, the documents that its predecessor kept, and the
folder of the other tables. All but the last return the columns of their
input; the last replaces the text by its token ids. Between stages the
documents are written to the shared folder and read again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logtrail.llm import byte_bpe, decontaminate, jaccard_rtree, pseudonyms, toxicity
from logtrail.llm.components import fresh_name, stored
from logtrail.llm.queries import EXAMPLE_KEY, bpe_files, read
from logtrail.session import configure

#: Near duplicates share at least this part (percent) of their distinct runs of so many words.
WORDS, PERCENT = 5, 80


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, trained on all labelled documents, does not take for toxic."""
    model = toxicity.train(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    name = fresh_name(docs, "toxicity")
    return toxicity.score(docs, model, into=name).where(F.col(name) < toxicity.THRESHOLD).drop(name)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest doc_id."""
    return jaccard_rtree.one_of_each(docs, WORDS, PERCENT)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.without_matches(docs, read(spark, sf_dir, "benchmark"))


def with_pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms for personal data, and their length anew where the text changed."""
    name = fresh_name(docs, "pii_count")
    done = pseudonyms.pseudonymise_column(docs, EXAMPLE_KEY, into=name)
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        done = done.withColumn("n_chars", F.when(F.col(name) > 0, length).otherwise(F.col("n_chars")))
    return done.drop(name)


def with_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document instead of its text, their number, and a digest of what they decode to."""
    path, pattern = bpe_files()
    return byte_bpe.encode_checked(docs, path, pattern).withColumn("n_tokens", F.size("token_ids").cast("bigint"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_near_duplicates),
    ("benchmark", without_benchmark),
    ("personal_data", with_pseudonyms),
    ("tokens", with_tokens),
]

#: The classifier and the similarity classes have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = read(configure(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
