"""Positions within ordered groups, for groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from bindery.session import stored

INDEX_BITS = 33  # monotonically_increasing_id: partition above, index in the partition below


def numbered(
    df: DataFrame, order: Sequence[str], by: Sequence[str] = (), into: str = "pos",
    start: int = 1, total: str | None = None,
) -> DataFrame:
    """Add the consecutive position of each row in its group, counted from ``start``.

    A window over the group would bring all its rows into one task. Here rows are range-partitioned
    by group and order, so a large group spreads over many tasks; each row keeps its index within its
    partition, and per partition and group one count is summed up to an offset. ``order`` must be
    total within a group. The ranged rows are written once, because two evaluations of a range
    partitioning may sample different bounds. ``total`` names a column for the group size.
    """
    keys = [*by, *order]
    slot = F.monotonically_increasing_id()
    # Null is a group of its own and must match itself in the join below.
    ranged = stored(df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_slot", slot), "ranged")
    ranged = ranged.withColumns(
        {"_part": F.shiftright("_slot", INDEX_BITS), "_index": F.col("_slot").bitwiseAND(F.lit((1 << INDEX_BITS) - 1))}
    ).drop("_slot")
    runs = ranged.groupBy(*by, "_part").agg(F.min("_index").alias("_first"), F.count("*").alias("_rows"))
    # One row per partition and group: a window over a group sees at most one row per partition.
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    before = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        *[F.col(name).alias(f"_by_{name}") for name in by], F.col("_part").alias("_run_part"),
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(group).alias("_total"),
    )
    runs = stored(runs, "runs")
    match = ranged["_part"] == runs["_run_part"]
    for name in by:
        match = match & ranged[name].eqNullSafe(runs[f"_by_{name}"])
    out = ranged.join(runs, match)
    kept = [ranged[name] for name in df.columns if name != into]
    kept.append((F.col("_index") + F.col("_shift") + F.lit(start)).alias(into))
    if total:
        kept.append(F.col("_total").alias(total))
    return out.select(*kept)


def split_balanced(
    df: DataFrame, n: int, order: Sequence[str], by: Sequence[str] = (), into: str = "chunk"
) -> DataFrame:
    """Contiguous groups whose sizes differ by at most one, larger ones first, numbered from zero.

    No groups and hence no rows for ``n`` zero. With more groups than rows the last groups are empty.
    """
    if n == 0:
        return df.withColumn(into, F.lit(0).cast("long")).limit(0)
    placed = numbered(df, order, by, into="_row", start=0, total="_of")
    small, extra = F.floor(F.col("_of") / n), F.col("_of") % n
    wide = extra * (small + 1)
    chunk = F.when(F.col("_row") < wide, F.floor(F.col("_row") / (small + 1))).otherwise(
        extra + F.floor((F.col("_row") - wide) / F.greatest(small, F.lit(1)))
    )
    return placed.withColumn(into, chunk.cast("long")).drop("_row", "_of")


def chunk_sizes(chunks: DataFrame, n: int, into: str = "chunk") -> DataFrame:
    """Rows per group, empty groups included."""
    counted = chunks.groupBy(into).agg(F.count("*").alias("rows"))
    groups = chunks.sparkSession.range(n).select(F.col("id").alias(into))
    return groups.join(counted, into, "left").select(into, F.coalesce("rows", F.lit(0)).alias("rows"))
