"""Versioned snapshots and the aliases that point at them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from bindery.operators.commits import claim

ALIASES = "alias string, snapshot string, version long"


def missing_snapshots(wanted: DataFrame, existing: DataFrame, name: str = "name") -> DataFrame:
    """Snapshots to create."""
    return wanted.join(existing.select(name).distinct(), name, "left_anti")


def snapshot_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/snapshot={name}"


def publish_snapshot(df: DataFrame, root: str, name: str, alias: str, version: int) -> DataFrame:
    """Write a snapshot unless it is there, then point the alias at it.

    The alias row comes last, so a reader sees the old snapshot or the whole new one. A snapshot
    counts as written only with its success marker; what a lost job left behind is replaced. The alias version is claimed
    before its row is written: of two publishers with different snapshots one wins and the other raises ``CommitConflict``.
    """
    spark = df.sparkSession
    path = snapshot_path(root, name)
    if not _complete(spark, path):
        df.write.mode("overwrite").parquet(path)
    claim(spark, f"{root.rstrip('/')}/claims/{alias}-{version}", name)
    row = spark.createDataFrame([(alias, name, version)], ALIASES)
    row.coalesce(1).write.mode("overwrite").parquet(f"{root.rstrip('/')}/aliases/{alias}-{version}")
    return read_aliases(spark, root)


def _complete(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    marker = jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker)


def read_aliases(spark: SparkSession, root: str) -> DataFrame:
    """The newest target of each alias."""
    rows = spark.read.schema(ALIASES).parquet(f"{root.rstrip('/')}/aliases/*")
    return rows.groupBy("alias").agg(F.max_by("snapshot", "version").alias("snapshot"))


def read_snapshot(spark: SparkSession, root: str, alias: str) -> DataFrame:
    """The snapshot an alias points at."""
    found = read_aliases(spark, root).filter(F.col("alias") == alias).first()
    if found is None:
        raise ValueError(f"no such alias: {alias}")
    return spark.read.parquet(snapshot_path(root, found["snapshot"]))
