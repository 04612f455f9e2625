"""Micro-batches that are committed whole: classified, routed, counted, applied to a bucketed snapshot, bound moved, in one record.

A batch is read once, by the write of its routed files; counts and violations are observed by that write, whose tasks count
once however often they are tried. Everything after reads those files. The record that makes the batch visible is written last,
with the epoch, the counts before and after, the branch and the bound. So a batch that dies between two steps has changed
nothing, one that is replayed after its record is left alone, and the bound moves with the load or not at all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from bindery.operators import buckets
from bindery.operators.changes import DELETED, UPDATED, classify_batch, net_changes
from bindery.operators.checks import ExpectationError
from bindery.session import shared_path
from bindery.sinks.files import RECORDS_PER_FILE

NO_EPOCH = -1


def write_observed(changes: DataFrame, path: str, key: str, bound: str | None = None, records_per_file: int = RECORDS_PER_FILE) -> dict:
    """Write updates and deletes into a folder each, in chunks, and return what the write saw.

    ``updated``, ``deleted`` and ``keyless`` are counts, ``until`` is the largest ``bound`` as text.
    """
    seen = Observation()
    last = F.max(F.col(bound).cast("string")) if bound else F.max(F.lit(None).cast("string"))
    observed = changes.observe(
        seen, F.count_if(F.col("change") == UPDATED).alias("updated"), F.count_if(F.col("change") == DELETED).alias("deleted"),
        F.count_if(F.col(key).isNull()).alias("keyless"), last.alias("until"),
    )
    observed.write.partitionBy("change").option("maxRecordsPerFile", records_per_file).parquet(path)
    # A frame that the planner knows to be empty is not observed.
    return {"updated": 0, "deleted": 0, "keyless": 0, "until": None} | seen.get


def branch_of(spark: SparkSession, updated: int, deleted: int) -> str:
    return classify_batch(spark.createDataFrame([(updated, deleted)], "updated long, deleted long")).first()["branch"]


def commit_batch(
    changes: DataFrame, root: str, epoch: int, payload: Sequence[str], order: Sequence[str], bound: str | None = None,
    routed: str | None = None,
) -> dict:
    """Apply a batch to the snapshot at ``root`` unless its epoch is committed; returns the record that holds it.

    A row without a key is a violation and stops the batch. A batch without changes commits its epoch and leaves the bound.
    """
    spark = changes.sparkSession
    base = buckets.current(spark, root)
    version, record = base
    if record.get("epoch", NO_EPOCH) >= epoch:
        return next(r for _, r in buckets.history(spark, root) if r.get("epoch", NO_EPOCH) == epoch)
    path = routed or shared_path(spark, "routed")
    seen = write_observed(changes, path, record["key"], bound)
    if seen["keyless"]:
        raise ExpectationError(f"rows: {seen['keyless']} without {record['key']} in epoch {epoch}")
    notes = {
        "epoch": epoch, "updated": seen["updated"], "deleted": seen["deleted"], "branch": branch_of(spark, seen["updated"], seen["deleted"]),
        "before": buckets.rows_of(record),
    }
    if seen["updated"] or seen["deleted"]:
        written = spark.read.schema(changes.schema).parquet(path)
        record = buckets.rewritten(spark, root, net_changes(written, record["key"], payload, order), base)
        if bound and seen["until"] is not None:
            notes |= {"bound": max(seen["until"], record.get("bound") or seen["until"]), "last_bound": record.get("bound")}
    record = {**record, **notes, "after": buckets.rows_of(record)}
    buckets.commit_version(spark, root, version + 1, record)
    return record


def commit_stream(
    changes: DataFrame, root: str, payload: Sequence[str], order: Sequence[str], bound: str | None = None,
) -> StreamingQuery:
    """Start applying a stream of changes to the snapshot at ``root``. It stops when all present files are done."""
    return (
        changes.writeStream.foreachBatch(lambda batch, epoch: commit_batch(batch, root, epoch, payload, order, bound) and None)
        .option("checkpointLocation", f"{root}/progress")
        .trigger(availableNow=True)
        .start()
    )


LOG = "epoch long, updated long, deleted long, branch string, before long, after long, bound string"


def epoch_log(spark: SparkSession, root: str) -> DataFrame:
    """One row for each committed epoch. Records are read by the driver; each is as small as the number of buckets."""
    names = [part.split()[0] for part in LOG.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for _, r in buckets.history(spark, root) if "epoch" in r], LOG)
