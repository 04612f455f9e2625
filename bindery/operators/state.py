"""Key-value state and harvest bounds as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from bindery.functions.keys import or_default


def upsert_state(state: DataFrame, updates: DataFrame) -> DataFrame:
    """State after the updates: the value with the highest version of each key."""
    rows = state.select("key", "value", "version").unionByName(updates.select("key", "value", "version"))
    # The value breaks ties, so that a rerun picks the same row.
    last = rows.groupBy("key").agg(F.max(F.struct("version", "value")).alias("last"))
    return last.select("key", "last.value", "last.version")


def read_state(state: DataFrame, default: Column | str | None, keys: DataFrame | None = None) -> DataFrame:
    """Values with blanks replaced by the default. With ``keys``, missing keys get it too."""
    rows = state if keys is None else keys.join(state, "key", "left")
    return rows.select("key", or_default(F.col("value"), default).alias("value"))


def harvest_bounds(runs: DataFrame, logical: str = "logical_time") -> DataFrame:
    """State rows to write after a run: the next start is this end, the last start is this start.

    ``runs`` has ``target``, ``harvest_from`` and ``harvest_until``; an unset end is the logical time.
    """
    until = or_default(F.col("harvest_until"), F.col(logical))
    rows = F.inline(
        F.array(
            F.struct(F.concat("target", F.lit("_FROM")).alias("key"), until.alias("value")),
            F.struct(F.concat("target", F.lit("_LAST_FROM")).alias("key"), F.col("harvest_from").alias("value")),
        )
    )
    return runs.select(rows)


def advance_bounds(state: DataFrame, runs: DataFrame, counts: DataFrame, version: Column) -> DataFrame:
    """State after the runs that changed something; the others leave their bounds."""
    done = runs.join(counts.filter((F.col("updated") > 0) | (F.col("deleted") > 0)).select("target"), "target", "left_semi")
    return upsert_state(state, harvest_bounds(done).withColumn("version", version))
