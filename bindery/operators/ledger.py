"""Ordered ledgers: pushing values, deciding what a prune keeps, and what is left afterwards.

A ledger may hold a large part of all rows, so no step brings one ledger into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from bindery.functions.keys import BLANKS
from bindery.functions.values import parse_list
from bindery.operators.positions import numbered
from bindery.session import stored

# Statuses, skip reasons, and the failure that counts as done.
OK, SKIPPED, FAILED = "OK", "SKIPPED", "FAILED"
SKIP_FROM_LAST, SKIP_INCLUDED, SKIP_MATCHING = "skip_from_last", "skip_included", "skip_matching"
ALREADY_GONE = "Could not find collection"
KEEP_LAST = 1


def matches_start(text: Column, pattern: str) -> Column:
    """Pattern match anchored at the start only."""
    return text.rlike(f"^(?:{pattern})")


def read_ledgers(state: DataFrame) -> DataFrame:
    """Ledger rows out of state values that hold lists. A blank value is an empty ledger; one that is no list is an error."""
    values = parse_list(F.col("value"))
    unread = F.raise_error(F.concat(F.lit("not a list, in ledger "), F.coalesce("key", F.lit("null")))).cast("array<string>")
    entries = F.posexplode(F.when(values.isNull(), unread).otherwise(values)).alias("place", "entry")
    return state.select(F.col("key").alias("ledger"), entries).select(
        "ledger", (F.col("place") + 1).cast("long").alias("pos"), F.col("entry").alias("value")
    )


def push(
    ledger: DataFrame, pushed: DataFrame, unique: bool = True, skip_blank: bool = True
) -> DataFrame:
    """Append values to ledgers. Both frames have ``ledger``, ``pos`` and ``value``.

    ``unique`` adds a value only if its ledger lacks it; repeats already stored stay. ``skip_blank``
    drops null and empty values, but not the word None. Positions are consecutive from one.
    """
    new = pushed.select("ledger", "pos", "value")
    if skip_blank:
        new = new.filter(F.col("value").isNotNull() & (F.col("value") != ""))
    if unique:
        new = new.groupBy("ledger", "value").agg(F.min("pos").alias("pos"))
        held = ledger.select(F.col("ledger").alias("_ledger"), F.col("value").alias("_value")).distinct()
        same = F.col("ledger").eqNullSafe(F.col("_ledger")) & F.col("value").eqNullSafe(F.col("_value"))
        new = new.join(held, same, "left_anti")
    rows = ledger.select("ledger", "pos", "value").withColumn("_new", F.lit(0)).unionByName(
        new.select("ledger", "pos", "value").withColumn("_new", F.lit(1))
    )
    rows = rows.withColumnRenamed("pos", "_order")
    return numbered(rows, ["_new", "_order"], by=["ledger"]).select("ledger", "pos", "value")


def last_cut(items: DataFrame, keep_last: int) -> DataFrame:
    """Position from which a ledger's last ``keep_last`` rows start.

    A rank filter over the positions: Spark keeps the top rows of each ledger in every task before the shuffle, so at most
    tasks x ledgers x ``keep_last`` rows of two columns are sent, whatever a ledger's size.
    """
    place = F.row_number().over(Window.partitionBy("ledger").orderBy(F.col("pos").desc()))
    last = items.select("ledger", "pos").withColumn("_at", place).filter(F.col("_at") <= keep_last)
    return stored(last.groupBy("ledger").agg(F.min("pos").alias("_cut")), "cut")


def prune_status(
    items: DataFrame, keep_last: int | None = KEEP_LAST, included: Sequence[str] | DataFrame = (),
    matching: str | None = None,
) -> DataFrame:
    """Status and reason of every item of a prune.

    ``items`` has ``ledger``, ``pos``, ``name``, and the outcome of an attempt in ``ok`` and
    ``failure``. The last rows by position are kept before any other rule; then names in the list,
    then names that match the pattern; what remains succeeded or failed. ``included`` is a short list,
    or a frame with a ``name`` column. A blank name in the list is an error, since it hints at a list
    that was meant to protect something. An item without an outcome counts as failed, so it stays.
    """
    if not isinstance(included, DataFrame) and any(name is None or name in BLANKS for name in included):
        raise ValueError("blank name in the list of names to skip")
    kept, listed = F.lit(False), F.lit(False)
    rows = items
    if keep_last:
        cut = last_cut(items, keep_last).withColumnRenamed("ledger", "_of_ledger")
        rows = rows.join(cut, rows["ledger"].eqNullSafe(cut["_of_ledger"]), "left")
        kept = F.coalesce(F.col("pos") >= F.col("_cut"), F.lit(False))
    if isinstance(included, DataFrame):
        # Written for the same reasons as the cut: a known size, and a join that can split a hot name.
        blank = F.col("name").isNull() | F.col("name").isin(*BLANKS)
        checked = F.when(blank, F.raise_error(F.lit("blank name in the list of names to skip")).cast("string")).otherwise(F.col("name"))
        names = stored(included.select(checked.alias("_listed")).distinct(), "listed")
        rows = rows.join(names, rows["name"] == names["_listed"], "left")
        listed = F.col("_listed").isNotNull()
    elif included:
        listed = F.col("name").isin(list(included))
    matched = matches_start(F.col("name"), matching) if matching else F.lit(False)
    reason = (
        F.when(kept, SKIP_FROM_LAST).when(listed, SKIP_INCLUDED).when(matched, SKIP_MATCHING)
        .when(~F.col("ok"), F.col("failure"))
    )
    status = F.when(kept | listed | matched, SKIPPED).when(F.col("ok"), OK).otherwise(FAILED)
    return rows.select("ledger", "pos", "name", status.alias("status"), reason.alias("reason"))


def ignorable_failure(status: Column, reason: Column, pattern: str | None) -> Column:
    """A failure whose reason starts with the pattern."""
    if not pattern:
        return F.lit(False)
    return (status == FAILED) & matches_start(F.coalesce(reason, F.lit("")), pattern)


def remaining(processed: DataFrame, ignore: str | None = ALREADY_GONE) -> DataFrame:
    """The ledger after a prune: failures that count first, then skipped items, each in order."""
    status, reason = F.col("status"), F.col("reason")
    stays = (status == SKIPPED) | ((status == FAILED) & ~ignorable_failure(status, reason, ignore))
    rows = processed.filter(stays).select(
        "ledger", F.when(status == FAILED, 0).otherwise(1).alias("_rank"),
        F.col("pos").alias("_order"), F.col("name").alias("value"),
    )
    return numbered(rows, ["_rank", "_order"], by=["ledger"]).select("ledger", "pos", "value")


def status_tally(processed: DataFrame) -> DataFrame:
    return processed.groupBy("status", "reason").agg(F.count("*").alias("items"))


def outcomes(processed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Succeeded and failed items, for the caller's own follow-up."""
    return processed.filter(F.col("status") == OK), processed.filter(F.col("status") == FAILED)
