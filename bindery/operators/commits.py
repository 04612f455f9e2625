"""Numbered records that can be written once: the last step of a change, after which readers see all of it."""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class CommitConflict(Exception):
    """Raised when somebody else has written the record first."""


def _file(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def put_if_absent(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file unless it exists. It is written aside and renamed, so it is never seen in part.

    A rename that must not overwrite is atomic where the file system's is, as on HDFS; an object store needs a committer
    with conditional writes behind this.
    """
    jvm = spark._jvm
    target, files = _file(spark, path)
    files.mkdirs(target.getParent())
    aside = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}-{uuid.uuid4().hex}")
    out = files.create(aside, False)
    try:
        out.write(text.encode())
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    plain = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(files.makeQualified(aside), files.makeQualified(target), plain)
    except Py4JJavaError as error:
        files.delete(aside, False)
        if files.exists(target):
            raise CommitConflict(path) from error
        raise


def claim(spark: SparkSession, path: str, owner: str) -> None:
    """Write the owner's name unless somebody else's is there. Claiming again for the same owner does nothing."""
    try:
        put_if_absent(spark, path, owner)
    except CommitConflict:
        if spark.read.text(path, wholetext=True).first()[0] != owner:
            raise


def _name(version: int) -> str:
    return f"{version:012d}.json"


def commit(spark: SparkSession, folder: str, version: int, record: dict) -> None:
    """Write the record of ``version``, or raise ``CommitConflict`` if there is one."""
    put_if_absent(spark, f"{folder}/{_name(version)}", json.dumps(record))


def versions(spark: SparkSession, folder: str) -> list[int]:
    """Committed versions in order."""
    path, files = _file(spark, folder)
    if not files.exists(path):
        return []
    names = [status.getPath().getName() for status in files.listStatus(path)]
    return sorted(int(name[: -len(".json")]) for name in names if name.endswith(".json") and not name.startswith("."))


def read_commit(spark: SparkSession, folder: str, version: int) -> dict:
    """The record of a version. Records are small: they grow with the buckets they name, not with rows."""
    return json.loads(spark.read.text(f"{folder}/{_name(version)}", wholetext=True).first()[0])


def last_commit(spark: SparkSession, folder: str) -> tuple[int, dict] | None:
    found = versions(spark, folder)
    return (found[-1], read_commit(spark, folder, found[-1])) if found else None
