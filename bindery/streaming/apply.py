"""Applying a stream of changes to a snapshot.

A micro-batch writes only its own net changes, one row per changed key, into a folder named by the
batch. Readers merge those rows over the base snapshot; ``compact`` folds them into a new base. So the
cost of a micro-batch follows the batch and not the snapshot, and a batch replayed after a failure
replaces its own folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from bindery.operators.changes import apply_net, net_changes
from bindery.session import stored


def stream_harvest(
    spark: SparkSession, path: str, schema: str, format: str = "parquet", files_per_trigger: int | None = None,
    archive: str | None = None,
) -> DataFrame:
    """New files of a folder as a stream. With ``archive``, files already read are moved there."""
    reader = spark.readStream.format(format).schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(path)


def apply_stream(
    changes: DataFrame, root: str, key: str, payload: Sequence[str], order: Sequence[str]
) -> StreamingQuery:
    """Start applying ``changes`` and return the query. It stops when all present files are done."""

    def write_net(batch: DataFrame, epoch: int) -> None:
        net = net_changes(batch, key, payload, order)
        net.write.mode("overwrite").parquet(f"{root}/changes/epoch={epoch}")

    # An epoch without rows, so that readers find the folder before the first batch.
    write_net(changes.sparkSession.createDataFrame([], changes.schema), -1)
    return (
        changes.writeStream.foreachBatch(write_net)
        .option("checkpointLocation", f"{root}/progress")
        .trigger(availableNow=True)
        .start()
    )


def pending_changes(spark: SparkSession, root: str, schema: str, key: str) -> DataFrame:
    """Net changes over all micro-batches: for each key the one of its last epoch."""
    rows = spark.read.schema(f"{schema}, _deleted boolean, epoch long").parquet(f"{root}/changes")
    others = [name for name in rows.columns if name not in (key, "epoch")]
    last = rows.groupBy(key).agg(F.max_by(F.struct(*others), "epoch").alias("_last"))
    return last.select(key, "_last.*")


def merged(snapshot: DataFrame, root: str, key: str) -> DataFrame:
    """The snapshot with all micro-batches applied."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in snapshot.schema.fields)
    pending = stored(pending_changes(snapshot.sparkSession, root, columns, key), "pending")
    return apply_net(snapshot, pending, key)


def compact(snapshot: DataFrame, root: str, key: str, path: str) -> DataFrame:
    """Fold the micro-batches into a new base at ``path``. The caller then starts a new root."""
    merged(snapshot, root, key).write.parquet(path)
    return snapshot.sparkSession.read.schema(snapshot.schema).parquet(path)
