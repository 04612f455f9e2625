"""Session helpers: a local session for tests, and tables written to the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", app: str = "bindery", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster job brings its own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
    )
    if "spark.checkpoint.dir" not in conf:
        conf["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="bindery-")
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_MADE: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach. Where the session names none, a local master gets one temporary folder."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _MADE:
        _MADE.append(tempfile.mkdtemp(prefix="bindery-"))
    return _MADE[0]


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path in this application's part of the shared folder."""
    return f"{_application_dir(spark)}/{label}-{uuid.uuid4().hex}"


def _application_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/bindery/{spark.sparkContext.applicationId}"


def clear_stored(spark: SparkSession) -> None:
    """Remove what this application stored. For the end of a job, when no frame on it is used any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_application_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    The written table survives lost executors, keeps nondeterministic columns fixed, lets later
    passes read only the columns they need, and gives the planner a real size, so a join on it is
    broadcast only when the files on disk are below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
