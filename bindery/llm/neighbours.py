"""Rows in one total order over all tasks, each with the rows next to it at hand."""

from __future__ import annotations

import sys
from bisect import bisect_right

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKETS = 3  # for each shuffle partition
SAMPLED = 60  # keys for each bucket, from which its bounds are taken


def in_order(df: DataFrame, keys: list[str], ties: list[str], wrap: bool = False, before: bool = False, only: DataFrame | None = None) -> DataFrame:
    """``df`` sorted within its partitions, in buckets of consecutive keys, with the neighbours from other buckets.

    Adds ``_bucket`` and ``_ghost``: 0 for a row's own place, 1 for a copy of the next bucket's first rows after the last row,
    and with ``before`` -1 for a copy of the previous bucket's last rows. With ``wrap`` the first rows follow the last ones.
    Keys must not be null. Rows with equal keys share a bucket and are ordered by ``ties``, so keys should end with one that
    tells rows apart. ``only`` may give the keys of all rows where ``df`` is dear to compute. The driver gets the keys of a sample of rows
    and each bucket's first and last key; their number depends on the partitions, not on the rows. Buckets are dealt to
    partitions in turn.
    """
    spark = df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = BUCKETS * partitions
    only = (df if only is None else only).select(*keys)
    share = min(1.0, wanted * SAMPLED / max(1, only.count()))
    sample = sorted(tuple(r) for r in only.sample(share, seed=1).collect())
    bounds = sorted({sample[i * len(sample) // wanted] for i in range(1, wanted)}) if sample else []

    def tuples(batch):
        return list(zip(*[batch.column(k).to_pylist() for k in keys]))

    def place(batches):
        for batch in batches:
            buckets = [bisect_right(bounds, t) for t in tuples(batch)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(buckets, pa.int32())], names=[*batch.schema.names, "_bucket"])

    key = F.struct(*keys)
    ends = only.mapInArrow(place, StructType([*only.schema.fields, StructField("_bucket", IntegerType())]))
    ends = sorted((r[0], tuple(r[1]), tuple(r[2])) for r in ends.groupBy("_bucket").agg(F.min(key), F.max(key)).collect())
    copies: dict[tuple, list[tuple[int, int]]] = {}
    for i, (bucket, first, last) in enumerate(ends):
        if i or wrap:
            copies.setdefault(first, []).append((ends[i - 1][0], 1))
        if before and i + 1 < len(ends):
            copies.setdefault(last, []).append((ends[i + 1][0], -1))

    def spread(batches):
        for batch in batches:
            at, buckets, ghosts = [], [], []
            for i, t in enumerate(tuples(batch)):
                for bucket, ghost in [(bisect_right(bounds, t), 0), *copies.get(t, ())]:
                    at.append(i)
                    buckets.append(bucket)
                    ghosts.append(ghost)
            rows = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(buckets, pa.int32()), pa.array(ghosts, pa.int32())], names=[*batch.schema.names, "_bucket", "_ghost"])

    schema = StructType([*df.schema.fields, StructField("_bucket", IntegerType()), StructField("_ghost", IntegerType())])
    dealt = df.mapInArrow(spread, schema).repartitionById(partitions, F.pmod("_bucket", F.lit(partitions)).cast("int"))
    return dealt.sortWithinPartitions("_bucket", "_ghost", *keys, *ties)
