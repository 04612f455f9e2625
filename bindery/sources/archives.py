"""Record batches packed as gzipped tar files."""

from __future__ import annotations

import io
import re
import sys
import tarfile
from collections.abc import Iterator
from xml.parsers import expat

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from bindery.schemas import KEEP_TEXT, XML_MARC
from bindery.sources.xml import marc_columns

# The functions below travel to the executors with the job, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MEMBERS = "src_key string, member string, rec_pos long, xml string"
BLOCK = 1 << 20
START_TAG = re.compile(rb"<(?:[^\"'>]|\"[^\"]*\"|'[^']*')*>")


def _record_slices(stream: io.BufferedIOBase, tag: str) -> Iterator[str]:
    """The source text of each direct child ``tag`` of the root element, read block by block."""
    held, base, depth, start, found, encoding = bytearray(), 0, 0, None, [], "utf-8"
    parser = expat.ParserCreate()

    def declared(_version: str, name: str | None, _standalone: int) -> None:
        nonlocal encoding
        encoding = name or encoding

    def opened(name: str, _attributes: dict) -> None:
        nonlocal depth, start
        if depth == 1 and name.rsplit(":", 1)[-1] == tag:
            start = parser.CurrentByteIndex
        depth += 1

    def closed(_name: str) -> None:
        nonlocal depth, start
        depth -= 1
        if depth == 1 and start is not None:
            found.append((start, parser.CurrentByteIndex))
            start = None

    parser.XmlDeclHandler, parser.StartElementHandler, parser.EndElementHandler = declared, opened, closed
    while True:
        block = stream.read(BLOCK)
        held += block
        parser.Parse(block, not block)
        for begin, end in found:
            # The parser gives where an end tag starts; for an empty element, where it stops.
            opening = START_TAG.match(held, begin - base)
            empty = opening[0].endswith(b"/>")
            stop = opening.end() if empty else held.index(b">", end - base) + 1
            yield held[begin - base : stop].decode(encoding)
        found.clear()
        if not block:
            return
        keep = start if start is not None else parser.CurrentByteIndex
        if keep > base:
            del held[: keep - base]
            base = keep


def expand_archives(files: DataFrame, tag: str = "record", batch_bytes: int = 8 << 20) -> DataFrame:
    """One row per record of every archive member, with its position.

    ``files`` has ``path`` and ``content``. Only the unpacking and the cut into records is Python;
    members and records are streamed, so a task holds one archive and one batch of records.
    """

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                yield from _unpacked(path, io.BytesIO(content.as_buffer()), tag, batch_bytes)

    return files.select("path", "content").mapInArrow(unpack, MEMBERS)


def _unpacked(path: str, stream: io.BufferedIOBase, tag: str, batch_bytes: int) -> Iterator[pa.RecordBatch]:
    """The records of one archive, read front to back."""
    rows, size, position = ([], [], [], []), 0, 0
    with tarfile.open(fileobj=stream, mode="r|*") as archive:
        for entry in archive:
            if not entry.isfile():
                continue
            for piece in _record_slices(archive.extractfile(entry), tag):
                for column, value in zip(rows, (path, entry.name, position, piece)):
                    column.append(value)
                position, size = position + 1, size + len(piece)
                if size >= batch_bytes:
                    yield _batch(rows)
                    rows, size = ([], [], [], []), 0
    if rows[0]:
        yield _batch(rows)


def _batch(rows: tuple[list, list, list, list]) -> pa.RecordBatch:
    types = (pa.string(), pa.string(), pa.int64(), pa.string())
    arrays = [pa.array(column, kind) for column, kind in zip(rows, types)]
    return pa.RecordBatch.from_arrays(arrays, names=["src_key", "member", "rec_pos", "xml"])


def read_archives(spark: SparkSession, path: str | list[str], mode: str = "FAILFAST") -> DataFrame:
    """Bibliographic records of gzipped tar files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return parse_records(expand_archives(files), mode)


def parse_records(records: DataFrame, mode: str = "FAILFAST") -> DataFrame:
    """Record XML text as typed records. Prefixes are dropped while parsing."""
    raw = F.from_xml("xml", XML_MARC, {**KEEP_TEXT, "mode": mode})
    parsed = records.select("src_key", "member", "rec_pos", raw.alias("raw"))
    return parsed.select(
        "src_key", "rec_pos",
        *marc_columns(F.col("raw.leader"), F.col("raw.controlfield"), F.col("raw.datafield")),
        F.col("raw._type").alias("record_type"), F.col("raw.`_airflow-record-id`").alias("airflow_record_id"),
    )
