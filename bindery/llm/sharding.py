"""Placement of keys on shards by a lookup table of prime size.

Every shard has an order of preference over the slots of the table, given by an offset and a step from two hashes of its
name; as the size is prime, each order holds every slot once. Shards take turns, each claiming the first free slot of its
order, until the table is full. Shards differ by one slot at most, and when a shard goes, few slots of the others change.
A key's slot is its hash modulo the size; the table is broadcast, so a key is placed by one lookup, without a shuffle.

The table has as many rows as the prime says, whatever the input: that bounds the broadcast. Null keys are placed like the
empty string. Keys that repeat go to the same shard. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SIZE = 65_537
MOST_SLOTS = 1 << 20  # of a table


def hash_of(value: Column, salt: str = "") -> Column:
    """60 bits of a digest, as a number."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(salt), F.coalesce(value.cast("string"), F.lit("")))), 1, 15), 16, 10).cast("long")


def preferences(spark: SparkSession, shards: list[str], size: int) -> list[tuple[int, int]]:
    """Offset and step of each shard."""
    names = spark.range(1).select(F.posexplode(F.array(*[F.lit(s) for s in shards])).alias("at", "name"))
    rows = names.select("at", (hash_of(F.col("name"), "offset:") % size).alias("offset"), (hash_of(F.col("name"), "step:") % (size - 1) + 1).alias("step"))
    return [(r.offset, r.step) for r in sorted(rows.collect())]


def fill(orders: list[tuple[int, int]], size: int) -> list[int]:
    """The shard of each slot, after all turns."""
    slots, following, claimed = [-1] * size, [offset for offset, _ in orders], 0
    while claimed < size:
        for shard, (_, step) in enumerate(orders):
            slot = following[shard]
            while slots[slot] >= 0:
                slot = (slot + step) % size
            slots[slot] = shard
            following[shard] = (slot + step) % size
            claimed += 1
            if claimed == size:
                break
    return slots


def lookup_table(spark: SparkSession, shards: list[str], size: int = SIZE) -> DataFrame:
    """(slot, shard), one row for each slot. The turns depend on each other, so the table is filled before it is sent out."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be named, each once")
    if size < len(shards) or size > MOST_SLOTS or any(size % k == 0 for k in range(2, int(size**0.5) + 1)):
        raise ValueError(f"the table's size must be a prime from the number of shards to {MOST_SLOTS}")
    slots = ",".join(map(str, fill(preferences(spark, shards, size), size)))
    listed = spark.range(1).select(F.posexplode(F.split(F.lit(slots), ",")).alias("slot", "at"))
    return listed.select(F.col("slot").cast("long").alias("slot"), F.element_at(F.array(*[F.lit(s) for s in shards]), F.col("at").cast("int") + 1).alias("shard"))


def place(df: DataFrame, key: str, tables: dict[str, DataFrame], size: int = SIZE) -> DataFrame:
    """``df`` with ``slot`` and one column for each lookup table, all of one size. A column of such a name is replaced."""
    new = {"slot", *(t.lower() for t in tables)}
    kept = [c for c in df.columns if c.lower() not in new]
    out = df.select(*kept, (hash_of(F.col(f"`{key}`")) % size).alias("slot"))
    for name, table in tables.items():
        # At most MOST_SLOTS rows of two short values.
        out = out.join(F.broadcast(table.withColumnRenamed("shard", name)), "slot", "left")
    return out.select(*kept, "slot", *tables)
