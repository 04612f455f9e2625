import random

import pytest
from pyspark.sql import functions as F

from bindery.operators.positions import chunk_sizes, numbered, split_balanced


@pytest.mark.parametrize("rows, n, sizes", [
    (6, 2, [3, 3]), (5, 2, [3, 2]), (3, 5, [1, 1, 1, 0, 0]), (3, 1, [3]), (3, 0, []), (0, 3, [0, 0, 0]), (1000, 7, [143] * 6 + [142]),
])
def test_split(spark, rows, n, sizes):
    chunks = split_balanced(spark.range(rows), n, ["id"])
    assert [r["rows"] for r in chunk_sizes(chunks, n).orderBy("chunk").collect()] == sizes
    placed = [r["chunk"] for r in chunks.orderBy("id").collect()]
    assert placed == sorted(placed)


def test_numbered_with_one_hot_group(spark):
    """A third of all rows in one group, a null group, and many groups of one row."""
    random.seed(3)
    rows = [("hot", i) for i in range(4000)] + [(None, i) for i in range(500)] + [(f"g{i % 2500}", i) for i in range(7500)]
    random.shuffle(rows)
    frame = spark.createDataFrame(rows, "g string, v long").repartition(7)
    out = numbered(frame, ["v"], by=["g"], total="n").collect()
    seen = {}
    for g, v in rows:
        seen.setdefault(g, []).append(v)
    want = {(g, v): (i, len(vs)) for g, vs in seen.items() for i, v in enumerate(sorted(vs), 1)}
    assert {(r["g"], r["v"]): (r["pos"], r["n"]) for r in out} == want and len(out) == len(rows)


def test_hot_group_is_spread(spark):
    """With small partitions kept apart, one group fills several of them."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    frame = numbered(spark.range(0, 100000, 1, 8).withColumn("g", F.lit("only")), ["id"], by=["g"])
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert tuple(frame.agg(F.min("pos"), F.max("pos"), F.count_distinct("pos")).first()) == (1, 100000, 100000)
    assert len([f for f in frame.inputFiles() if "/ranged-" in f]) > 1


def test_renumbers_an_existing_column(spark):
    frame = spark.createDataFrame([("a", 10), ("a", 30), ("b", 20)], "ledger string, pos long")
    assert sorted(tuple(r) for r in numbered(frame, ["pos"], by=["ledger"]).collect()) == [("a", 1), ("a", 2), ("b", 1)]
