"""Whole texts as Arrow batches: byte access, bounded parts, and columns computed from them."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

# Functions of this subpackage travel with the job, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Text bytes that one call of a batch function gets, unless a single text is longer.
PART_BYTES = 4 << 20

Columns = list[pa.Array]
Work = Callable[[], Callable[[Columns], Columns]]


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in one array, and where each begins and ends in it. Null is empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, ends, data = texts.buffers()
    ends = np.frombuffer(ends, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def parts(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with at most ``limit`` text bytes each, or one row."""
    sizes = utf8(batch.column(column))[1] if len(batch) else np.zeros(1, np.int64)
    start = 0
    while start < len(batch):
        stop = max(start + 1, int(np.searchsorted(sizes, sizes[start] + limit, "right")) - 1)
        yield batch.slice(start, stop - start)
        start = stop


def named(column: str) -> Column:
    """The column of exactly this name, which may hold dots and quotes."""
    return F.col("`" + column.replace("`", "``") + "`")


def place_of(df: DataFrame, column: str) -> int:
    """Where ``df`` has the column, by its name as Spark compares names."""
    exact = [i for i, c in enumerate(df.columns) if c == column]
    return (exact or [i for i, c in enumerate(df.columns) if c.lower() == column.lower()])[0]


def numbered(df: DataFrame, *columns: str) -> tuple[DataFrame, list[str]]:
    """``df`` with columns named by their place only, and the new names of ``columns``.

    What an operator adds under a name of its own then can't clash with a column of the input. ``restored`` undoes it.
    """
    return df.toDF(*[f"own{i}" for i in range(len(df.columns))]), [f"own{place_of(df, c)}" for c in columns]


def restored(df: DataFrame, original: DataFrame) -> DataFrame:
    """The columns that ``numbered`` renamed, in their order and with their names."""
    return df.select(*[f"own{i}" for i in range(len(original.columns))]).toDF(*original.columns)


def add_columns(df: DataFrame, inputs: list[str], fields: list[StructField], work: Work, limit: int = PART_BYTES) -> DataFrame:
    """``df`` with columns that ``work()`` computes from ``inputs``, of which the first is the text.

    ``work`` is called once in each task. A column of ``df`` that has the name of a new one is replaced.
    """
    new = {f.name.lower() for f in fields}
    kept = [c for c in df.columns if c.lower() not in new]
    schema = StructType([df.schema[c] for c in kept] + fields)
    # Inputs that a new column replaces are still read, after all others.
    read = df.select(*[named(c).alias(f"own{i}") for i, c in enumerate(kept)], *[named(c).alias(f"in{i}") for i, c in enumerate(inputs)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = None
        for batch in batches:
            for part in parts(batch, "in0", limit):
                function = function or work()
                made = function([part.column(f"in{i}") for i in range(len(inputs))])
                yield pa.RecordBatch.from_arrays([part.column(i) for i in range(len(kept))] + made, names=schema.names)
        function = None
        released()

    return read.mapInArrow(run, schema)


def released() -> None:
    """Give memory that this worker has freed back to the system. Workers are kept for later tasks and would hold on to it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the C library, if it has it
    if trim is not None:
        trim(0)


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def limit_rows(spark: SparkSession, most: int) -> None:
    """From now on Arrow batches of at most ``most`` rows. The JVM and the worker each hold whole batches."""
    if not 0 < int(spark.conf.get(BATCH_ROWS)) <= most:  # 0 and less: no limit
        spark.conf.set(BATCH_ROWS, str(most))


@contextmanager
def rows_per_batch(spark: SparkSession, most: int) -> Iterator[None]:
    """``limit_rows`` for frames written inside."""
    before = spark.conf.get(BATCH_ROWS)
    limit_rows(spark, most)
    try:
        yield
    finally:
        spark.conf.set(BATCH_ROWS, before)
