"""Snapshots kept in buckets by key: a batch rewrites only the buckets that hold a changed key.

A bucket's rows lie in a folder of their own, and the record of a version says which folder that is for each bucket. A new
version writes the touched buckets into a new folder and names the old places of the rest, so files of untouched buckets stay as
they are. The record is written last and once: readers see a version whole or not at all, a job that dies leaves folders that
no record names, and of two writers of one version one fails.

The record grows with the number of buckets, so choose it by size: some hundred MB a bucket, at most ``MOST_BUCKETS``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from bindery.operators.changes import apply_net
from bindery.operators.commits import commit, last_commit, read_commit, versions
from bindery.session import stored

BUCKET = "key_bucket"
MOST_BUCKETS = 1 << 16


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _records(root: str) -> str:
    return f"{root}/versions"


def _write(rows: DataFrame, root: str, version: int, key: str, buckets: int) -> dict[str, list]:
    """Write rows by bucket; of each bucket its folder and number of rows, the latter out of the files' footers."""
    folder = f"{version}-{uuid.uuid4().hex}"
    path = f"{root}/data/{folder}"
    placed = rows.withColumn(BUCKET, bucket_of(F.col(key), buckets))
    # Rows are brought together by bucket; one with a large part of all rows is split over tasks when the query runs.
    placed.hint("rebalance", F.col(BUCKET)).write.partitionBy(BUCKET).parquet(path)
    schema = StructType([*rows.schema.fields, StructField(BUCKET, IntegerType())])
    counts = rows.sparkSession.read.schema(schema).parquet(path).groupBy(BUCKET).agg(F.count("*").alias("rows"))
    return {str(r[BUCKET]): [folder, r["rows"]] for r in counts.collect()}


def _read(spark: SparkSession, root: str, record: dict, only: list[int] | None = None) -> DataFrame:
    schema = StructType.fromJson(record["schema"])
    chosen = record["places"] if only is None else {str(b): record["places"][str(b)] for b in only if str(b) in record["places"]}
    paths = [f"{root}/data/{folder}/{BUCKET}={bucket}" for bucket, (folder, _) in chosen.items()]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def rows_of(record: dict) -> int:
    return sum(rows for _, rows in record["places"].values())


def create_snapshot(df: DataFrame, root: str, key: str, buckets: int, **notes) -> dict:
    """Write the first version of a snapshot with one row for each key."""
    if not 0 < buckets <= MOST_BUCKETS:
        raise ValueError(f"from one to {MOST_BUCKETS} buckets")
    if BUCKET in df.columns:
        raise ValueError(f"a column is named {BUCKET}")
    record = {"buckets": buckets, "key": key, "schema": df.schema.jsonValue(), "places": _write(df, root, 0, key, buckets), **notes}
    commit(df.sparkSession, _records(root), 0, record)
    return record


def current(spark: SparkSession, root: str) -> tuple[int, dict]:
    """Number and record of the newest version."""
    found = last_commit(spark, _records(root))
    if found is None:
        raise ValueError(f"no snapshot at {root}")
    return found


def read_snapshot(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The rows of a version, the newest one if none is given."""
    record = current(spark, root)[1] if version is None else read_commit(spark, _records(root), version)
    return _read(spark, root, record)


def rewritten(spark: SparkSession, root: str, net: DataFrame, base: tuple[int, dict]) -> dict:
    """The record that follows ``base`` when the net changes are applied: touched buckets are written, nothing is committed."""
    version, record = base
    key, buckets = record["key"], record["buckets"]
    net = stored(net.withColumn(BUCKET, bucket_of(F.col(key), buckets)), "net")
    touched = [r[0] for r in net.select(BUCKET).distinct().collect()]  # at most as many as there are buckets
    places = {b: p for b, p in record["places"].items() if int(b) not in set(touched)}
    if touched:
        places |= _write(apply_net(_read(spark, root, record, touched), net.drop(BUCKET), key), root, version + 1, key, buckets)
    return {**record, "places": places}


def commit_version(spark: SparkSession, root: str, version: int, record: dict) -> None:
    commit(spark, _records(root), version, record)


def apply_to_buckets(spark: SparkSession, root: str, net: DataFrame, **notes) -> dict:
    """Apply net changes to the newest version and commit the next one."""
    base = current(spark, root)
    record = rewritten(spark, root, net, base) | notes
    commit_version(spark, root, base[0] + 1, record)
    return record


def history(spark: SparkSession, root: str) -> list[tuple[int, dict]]:
    return [(v, read_commit(spark, _records(root), v)) for v in versions(spark, _records(root))]


def vacuum(spark: SparkSession, root: str, keep: int = 1) -> list[str]:
    """Delete data folders that none of the last ``keep`` versions names, such as those of jobs that died. No job may be writing."""
    named = {folder for _, record in history(spark, root)[-keep:] for folder, _ in record["places"].values()}
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/data")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = [s.getPath() for s in files.listStatus(path) if s.getPath().getName() not in named]
    for folder in gone:
        files.delete(folder, True)
    return sorted(folder.getName() for folder in gone)
