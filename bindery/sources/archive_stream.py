"""Archives of any size as a data source: partitions name archives, tasks stream them from the shared file system."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from bindery.sources.archives import MEMBERS, _unpacked, parse_records

# The classes below travel to the executors with the job, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "tar_records"
PARTITION_BYTES = 128 << 20
BATCH_BYTES = 8 << 20


@dataclass
class Archives(InputPartition):
    """The archives one task reads."""

    paths: list[str]


def _listed(path: str) -> list[tuple[str, int]]:
    """Paths and sizes of the files at or below ``path``, by path. Hidden ones are left out, as Spark does."""
    system, root = _system(path)
    found = system.get_file_info(root)
    if found.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if found.is_file:
        return [(found.path, found.size)]
    files = [f for f in system.get_file_info(fs.FileSelector(root, recursive=True)) if f.is_file]
    hidden = lambda name: any(part[:1] in "._" for part in name[len(root) :].strip("/").split("/"))
    return sorted((f.path, f.size) for f in files if not hidden(f.path))


def _system(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path in it. A path without a scheme is local; ``file:/x`` is the form that Spark prints."""
    if path.startswith("file:"):
        path = path[5:] if not path.startswith("file://") else path[7:]
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def _groups(files: list[tuple[str, int]], limit: int) -> list[list[str]]:
    """Neighbouring files put together up to ``limit`` bytes; a larger file stays alone."""
    groups, held = [], 0
    for path, size in files:
        if not groups or held + size > limit:
            groups.append([])
            held = 0
        groups[-1].append(path)
        held += size
    return groups


class ArchiveReader(DataSourceReader):
    def __init__(self, options) -> None:
        if "path" not in options:
            raise ValueError("load() needs a path")
        self.path, self.tag = options["path"], options.get("rowTag", "record")
        self.limit = int(options.get("maxPartitionBytes", PARTITION_BYTES))

    def partitions(self) -> list[Archives]:
        return [Archives(group) for group in _groups(_listed(self.path), self.limit)] or [Archives([])]

    def read(self, partition: Archives) -> Iterator[pa.RecordBatch]:
        system, root = _system(self.path)
        for path in partition.paths:
            # What Spark's own sources print: the path asked for, with its scheme.
            shown = f"file:{path}" if system.type_name == "local" else self.path.rstrip("/") + path[len(root.rstrip("/")) :]
            with system.open_input_stream(path, compression=None) as stream:
                yield from _unpacked(shown, stream, self.tag, BATCH_BYTES)


class ArchiveSource(DataSource):
    """``spark.read.format("tar_records")``: a row for each record of each archive at ``path``.

    Columns ``src_key``, ``member``, ``rec_pos`` (place of the record in its archive) and ``xml``. Options: ``rowTag`` and
    ``maxPartitionBytes``, up to which small archives share a task. A task holds a block of one archive and a batch of
    records, so neither has to fit in memory whole. A damaged archive fails the job; an empty folder has no rows.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return MEMBERS

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(self.options)


def stream_members(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Record text of every archive at ``path``, streamed. Any file system that Arrow can open: local, s3, gs, hdfs."""
    spark.dataSource.register(ArchiveSource)
    return spark.read.format(FORMAT).options(**options).load(path)


def stream_archives(spark: SparkSession, path: str, mode: str = "FAILFAST", **options: str) -> DataFrame:
    """``read_archives`` for archives too large for one value."""
    return parse_records(stream_members(spark, path, **options), mode)
