"""From raw documents to token ids in five stages, each an operator of ``bindery.llm``."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindery.llm import byte_bpe, common, jaccard_join, secret_scan, suffix_search, toxicity
from bindery.llm.queries import table, vocabulary
from bindery.session import stored

BATCH_ROWS = 1000  # texts that a worker is handed at a time

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def small_batches(stage: Stage) -> Stage:
    """``stage`` in a session that hands workers few rows at a time. Its frame is written later, so the setting stays."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        common.limit_rows(spark, BATCH_ROWS)
        return stage(spark, docs, sf_dir)

    return run_stage


@small_batches
def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted to be toxic go."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


@small_batches
def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by similarity the one with the smallest id stays."""
    return jaccard_join.one_of_each(docs)


@small_batches
def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of the benchmark go."""
    return suffix_search.decontaminate(docs, table(spark, sf_dir, "benchmark"))


@small_batches
def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; secrets in its text are replaced by a mark, and its length follows."""
    redacted = secret_scan.redact(docs)
    if "n_chars" not in docs.columns:
        return redacted
    length = F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType)
    return redacted.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), length))


@small_batches
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digests of a round trip."""
    return byte_bpe.round_trip(docs, vocabulary(), with_ids=True).select("doc_id", "lang", "source", "n_tokens", "ids_sha256", "decoded_sha256", "ids")


STAGES = [
    ("toxicity", without_toxic),
    ("ngram_jaccard_join", without_copies),
    ("suffix_array_decontamination", without_benchmark),
    ("secret_scan", without_secrets),
    ("byte_bpe", tokens),
]

# Learned scores, similarity joins and token ids have no SQL form; tests compare with plain code instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
