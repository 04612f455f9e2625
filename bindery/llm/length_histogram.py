"""Exact histogram of encoded lengths, and suffix sums over it.

Documents are encoded whole and counted by their number of tokens. Suffix sums over the histogram then answer for every
context limit how many documents and tokens reach it and how many tokens are left when all are cut there, and quantiles.
The histogram has a row for each length that occurs. Its sums are made in two levels, within blocks of lengths and over
block totals, so no task gets more than a block's lengths or all blocks.

Nulls and empty texts have length 0. Ties share a row. Rows that repeat count each. An empty table has no lengths.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from bindery.llm import byte_bpe, common

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 4096


def encoded_lengths(docs: DataFrame, vocabulary: bytes, text: str = "text") -> DataFrame:
    """``docs`` with ``length``, the number of tokens of its text."""

    def work():
        model = byte_bpe.ByteBpe(vocabulary)
        return lambda columns: [pa.array(np.diff(np.append(0, model.encode(*common.utf8(columns[0]))[1])), pa.int64())]

    return common.add_columns(docs, [text], [StructField("length", LongType())], work)


def histogram(lengths: DataFrame, length: str = "length") -> DataFrame:
    """(length, docs): how many rows have each length. Null lengths count as 0."""
    return lengths.select(F.coalesce(F.col(length).cast("long"), F.lit(0)).alias("length")).groupBy("length").agg(F.count(F.lit(1)).alias("docs"))


def suffix_sums(counts: DataFrame) -> DataFrame:
    """For each length that occurs, taken as a context limit, what reaches it and what is left of all documents cut there.

    ``counts`` is read twice, so store it if texts are encoded to make it.
    """
    block = counts.withColumn("block", F.floor(F.col("length") / BLOCK))
    block = block.withColumn("tokens", F.col("length") * F.col("docs"))
    totals = block.groupBy("block").agg(F.sum("docs").alias("block_docs"), F.sum("tokens").alias("block_tokens"))
    later = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = totals.select(
        "block", F.coalesce(F.sum("block_docs").over(later), F.lit(0)).alias("docs_later"), F.coalesce(F.sum("block_tokens").over(later), F.lit(0)).alias("tokens_later"),
        F.sum("block_docs").over(everything).alias("all_docs"), F.sum("block_tokens").over(everything).alias("all_tokens"),
    )
    within = Window.partitionBy("block").orderBy(F.desc("length"))
    reached = block.select("length", "docs", "block", F.sum("docs").over(within).alias("docs_here"), F.sum("tokens").over(within).alias("tokens_here"))
    joined = reached.join(totals, "block").withColumns({
        "docs_at_least": F.col("docs_here") + F.col("docs_later"), "tokens_at_least": F.col("tokens_here") + F.col("tokens_later"),
    })
    return joined.select(
        "length", "docs", "docs_at_least", "tokens_at_least",
        (F.col("all_tokens") - F.col("tokens_at_least") + F.col("length") * F.col("docs_at_least")).alias("truncated_total"),
        (F.col("all_docs") - F.col("docs_at_least") + F.col("docs")).alias("docs_up_to"),
        (F.col("all_tokens") - F.col("tokens_at_least") + F.col("length") * F.col("docs")).alias("tokens_up_to"),
        ((F.col("all_docs") - F.col("docs_at_least") + F.col("docs")) / F.col("all_docs")).alias("quantile"),
    )


def at_limits(sums: DataFrame, limits: list[int]) -> DataFrame:
    """(context, docs_at_least, truncated_total) for any context limits, by the next length that occurs."""
    wanted = F.explode(F.array(*[F.lit(int(x)).cast("long") for x in sorted(set(limits))])).alias("context")
    longest = F.max(F.struct("length", "tokens_up_to")).alias("longest")
    following = F.min(F.when(F.col("length") >= F.col("context"), F.struct("length", "docs_at_least", "tokens_at_least"))).alias("next")
    found = sums.select(wanted, *sums.columns).groupBy("context").agg(longest, following)
    docs, tokens = F.coalesce("next.docs_at_least", F.lit(0)), F.coalesce("next.tokens_at_least", F.lit(0))
    return found.select("context", docs.alias("docs_at_least"), (F.col("longest.tokens_up_to") - tokens + F.col("context") * docs).alias("truncated_total"))


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """(share, length): the least length that at least this share of the documents don't exceed."""
    wanted = F.explode(F.array(*[F.lit(float(x)) for x in sorted(set(shares))])).alias("share")
    return sums.select(wanted, "length", "quantile").where("quantile >= share").groupBy("share").agg(F.min("length").alias("length"))
