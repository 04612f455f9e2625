"""Selecting harvested changes and applying them to a snapshot."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from bindery.session import stored

UPDATED, DELETED = "new-updated", "deleted"


def harvest_window(
    records: DataFrame, since: Column | None = None, until: Column | None = None,
    sets: Sequence[str] | None = None, datestamp: str = "datestamp", set_column: str = "sets",
) -> DataFrame:
    """Records stamped within the bounds, both included, and in any of the sets.

    A missing bound is open. The bounds reach the scan as pushed filters.
    """
    out = records
    if since is not None:
        out = out.filter(F.col(datestamp) >= since)
    if until is not None:
        out = out.filter(F.col(datestamp) <= until)
    if sets is not None:
        out = out.filter(F.arrays_overlap(F.col(set_column), F.array(*[F.lit(name) for name in sets])))
    return out


def harvest(
    records: DataFrame, since: Column | None = None, until: Column | None = None,
    sets: Sequence[str] | None = None, transform: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """A harvest window with the caller's own step on its records."""
    out = harvest_window(records, since, until, sets)
    return out.transform(transform) if transform else out


def route_changes(records: DataFrame, deleted: Column) -> DataFrame:
    """Name the folder of each record."""
    return records.withColumn("change", F.when(deleted, F.lit(DELETED)).otherwise(F.lit(UPDATED)))


def change_counts(changes: DataFrame, by: Sequence[str]) -> DataFrame:
    """Updates and deletes of each batch."""
    return changes.groupBy(*by).agg(
        F.count_if(F.col("change") == UPDATED).alias("updated"),
        F.count_if(F.col("change") == DELETED).alias("deleted"),
    )


def classify_batch(counts: DataFrame) -> DataFrame:
    """What a batch needs. Missing counts are zero."""
    updates = F.coalesce("updated", F.lit(0)) > 0
    deletes = F.coalesce("deleted", F.lit(0)) > 0
    branch = (
        F.when(updates & deletes, "updates_and_deletes_branch")
        .when(updates, "updates_only_branch")
        .when(deletes, "deletes_only_branch")
        .otherwise("no_updates_no_deletes_branch")
    )
    return counts.withColumn("branch", branch)


def pre_post_counts(docs: DataFrame, phase: str = "phase") -> DataFrame:
    """Documents counted before and after a load; a phase without rows counts zero."""
    return docs.agg(
        F.count_if(F.col(phase) == "pre").alias("pre"), F.count_if(F.col(phase) == "post").alias("post")
    )


def latest_change(changes: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The newest row of each key; ``order`` must be total. Tasks keep one row per key before the shuffle."""
    others = [name for name in changes.columns if name != key]
    newest = changes.groupBy(key).agg(F.max_by(F.struct(*others), F.struct(*order)).alias("newest"))
    return newest.select(key, "newest.*")


def net_changes(changes: DataFrame, key: str, payload: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per changed key: its latest update, and whether the batch deletes it.

    Deletes come after updates, so a key with both ends deleted whatever their stamps.
    """
    removed = F.col("change") == DELETED
    row = F.max_by(F.struct(*payload), F.when(~removed, F.struct(*order)))
    net = changes.groupBy(key).agg(row.alias("_row"), F.bool_or(removed).alias("_deleted"))
    return net.select(key, "_row.*", "_deleted")


def apply_net(snapshot: DataFrame, net: DataFrame, key: str) -> DataFrame:
    """Snapshot rows without a change, and the changed rows that stay.

    One anti join on the keys of the change set. Given as a table with a known size, a small change
    set is broadcast and the snapshot is neither shuffled nor sorted.
    """
    untouched = snapshot.join(net.select(key), key, "left_anti")
    stay = net.filter(~F.col("_deleted")).drop("_deleted")
    return untouched.unionByName(stay.select(*snapshot.columns))


def apply_changes(
    snapshot: DataFrame, changes: DataFrame, key: str, payload: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Upsert the updates of a batch, then remove its deletes. Doing it twice changes nothing."""
    return apply_net(snapshot, stored(net_changes(changes, key, payload, order), "net"), key)


def delete_keys(snapshot: DataFrame, deletes: DataFrame, key: str) -> DataFrame:
    """Snapshot without the deleted keys. They are made distinct first, so a repeated one is sent once."""
    return snapshot.join(deletes.select(key).distinct(), key, "left_anti")
