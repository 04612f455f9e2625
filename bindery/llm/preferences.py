"""Preference pairs of conversations, formatted for training.

A pair is a chosen and a rejected conversation. The turns in which they agree from the beginning are the prompt, rendered
once; the rest of each is its completion. Every turn is a row with its rendered text and the span of it that is trained on:
the words of the assistant and the mark that ends them, in completions only. Nothing gathers a conversation's turns into
one value, so a conversation may have any number of them.

Two turns agree if number, role and text are equal; two nulls are. A turn number that a conversation has twice, or that
only one of the two has, ends the prompt before it. Turns are in the order of their number, nulls last. Rows that repeat
are rendered each. A conversation without a partner is a pair whose other side is empty, and its prompt has no turns. Rows
without a conversation belong to no pair and are left out. Marks inside a text are broken up. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
LAST = 2**63 - 1


def render(turns: DataFrame) -> DataFrame:
    """``turns`` with ``rendered`` and the span ``said`` .. of it that holds the words and the end mark."""
    text = F.regexp_replace(F.coalesce("text", F.lit("")), r"<\|", "< |")
    head = F.concat(F.lit(START), F.coalesce("role", F.lit("")), F.lit("\n"))
    return turns.withColumns({"rendered": F.concat(head, text, F.lit(END + "\n")), "said": F.length(head).cast("long")})


def format_pairs(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """Rows (pair_id, part, turn, role, rendered, mask_start, mask_end) for turns (pair_id, turn, role, text).

    ``part`` is prompt, chosen or rejected. The mask is empty where nothing is trained on.
    """
    columns = ("pair_id", "turn", "role", "text")
    turns = chosen.select(*columns, F.lit("chosen").alias("side")).unionAll(rejected.select(*columns, F.lit("rejected").alias("side")))
    turns = turns.where("pair_id IS NOT NULL").withColumn("at", F.coalesce(F.col("turn").cast("long"), F.lit(LAST)))
    said = F.struct("role", "text")
    both = turns.groupBy("pair_id", "at").agg(
        F.count(F.when(F.col("side") == "chosen", 1)).alias("c"), F.count(F.when(F.col("side") == "rejected", 1)).alias("r"),
        F.min(said).alias("low"), F.max(said).alias("high"),
    )
    agree = (F.col("c") == 1) & (F.col("r") == 1) & F.col("low").eqNullSafe(F.col("high"))
    # The first turn that isn't common; null if all are.
    cut = both.groupBy("pair_id").agg(F.min(F.when(~agree, F.col("at"))).alias("cut"))
    marked = turns.join(cut, "pair_id")
    common = F.col("cut").isNull() | (F.col("at") < F.col("cut"))
    kept = marked.withColumn("part", F.when(common, F.lit("prompt")).otherwise(F.col("side"))).where(~common | (F.col("side") == "chosen"))
    trained = (F.col("part") != "prompt") & (F.col("role") == "assistant")
    return render(kept).select(
        "pair_id", "part", "turn", "role", "rendered",
        F.when(trained, F.col("said")).otherwise(F.lit(0)).cast("long").alias("mask_start"),
        F.when(trained, F.length("rendered") - 1).otherwise(F.lit(0)).cast("long").alias("mask_end"),
    )


def pairs_by_id(conversations: DataFrame, conversation: str = "conv_id") -> tuple[DataFrame, DataFrame]:
    """Chosen and rejected turns, where conversations 2k and 2k + 1 are a pair and the even one is chosen."""
    number = F.col(conversation).cast("long")
    turns = conversations.select(F.floor(number / F.lit(2)).cast("long").alias("pair_id"), "turn", "role", "text", (F.pmod(number, F.lit(2)) == 0).alias("_even"))
    return turns.where("_even").drop("_even"), turns.where("NOT _even").drop("_even")
