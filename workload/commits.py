"""Bucketed snapshots, committed micro-batches, emptied folders and move plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from bindery.operators import buckets, changes as O, files as L
from bindery.session import shared_path, stored
from bindery.streaming.apply import stream_harvest
from bindery.streaming.epochs import commit_stream, epoch_log
from workload.changes import CHANGES, ORDER, PAYLOAD, line_changes, order_snapshot
from workload.registry import query, table

BUCKETS = 16
BATCHES = 3


@query("bucketed_apply", f"WITH {CHANGES} SELECT * FROM applied")
def bucketed_apply(spark, sf_dir):
    """The whole change set on a snapshot in buckets."""
    root = shared_path(spark, "buckets")
    buckets.create_snapshot(order_snapshot(spark, sf_dir), root, "record_id", BUCKETS)
    net = O.net_changes(line_changes(table(spark, sf_dir, "lineitem")), "record_id", PAYLOAD, ORDER)
    buckets.apply_to_buckets(spark, root, net)
    return buckets.read_snapshot(spark, root)


def epochs(spark, sf_dir) -> str:
    """Line items in three drops by line number, one micro-batch each. Orders have lines in several of them.

    A drop has a file for each task that reads the table, so no task reads or writes a whole one.
    """
    lines = table(spark, sf_dir, "lineitem")
    inbox, root = shared_path(spark, "inbox"), shared_path(spark, "epochs")
    buckets.create_snapshot(order_snapshot(spark, sf_dir), root, "record_id", BUCKETS)
    for i in range(BATCHES):
        lines.filter(F.col("l_linenumber") % BATCHES == i).write.mode("append").parquet(inbox)
        # Started again, the stream takes the files that came since, as one epoch.
        stream = stream_harvest(spark, inbox, lines.schema)
        commit_stream(line_changes(stream), root, PAYLOAD, ORDER, bound="stamp").awaitTermination()
    return root


def _epochs_sql() -> str:
    steps = [CHANGES.split("latest AS")[0].rstrip().rstrip(","), "s0 AS (SELECT * FROM snapshot)"]
    for i in range(BATCHES):
        steps.append(f"""
b{i} AS (SELECT * FROM changed WHERE line % {BATCHES} = {i}),
u{i} AS (
  SELECT record_id, stamp, part, supplier, line, price FROM (
    SELECT *, row_number() OVER (PARTITION BY record_id
                                 ORDER BY stamp DESC, part DESC, supplier DESC, line DESC, price DESC) AS rn
    FROM b{i} WHERE NOT gone) WHERE rn = 1),
s{i + 1} AS (
  SELECT * FROM (SELECT * FROM s{i} WHERE record_id NOT IN (SELECT record_id FROM u{i}) UNION ALL SELECT * FROM u{i})
  WHERE record_id NOT IN (SELECT record_id FROM b{i} WHERE gone))""")
    return "WITH " + ",\n".join(steps)


@query("epochs_apply", f"{_epochs_sql()} SELECT * FROM s{BATCHES}")
def epochs_apply(spark, sf_dir):
    return buckets.read_snapshot(spark, epochs(spark, sf_dir))


_LOG = " UNION ALL ".join(f"""
SELECT CAST({i} AS BIGINT) AS epoch, count(*) FILTER (NOT gone) AS updated, count(*) FILTER (gone) AS deleted,
       CASE WHEN count(*) FILTER (NOT gone) > 0 AND count(*) FILTER (gone) > 0 THEN 'updates_and_deletes_branch'
            WHEN count(*) FILTER (NOT gone) > 0 THEN 'updates_only_branch' ELSE 'deletes_only_branch' END AS branch,
       (SELECT count(*) FROM s{i}) AS before, (SELECT count(*) FROM s{i + 1}) AS after,
       (SELECT max(stamp) FROM changed WHERE line % {BATCHES} <= {i}) AS bound
FROM b{i}""" for i in range(BATCHES))


@query("epoch_log", f"{_epochs_sql()} {_LOG}")
def committed_epochs(spark, sf_dir):
    """What each committed micro-batch saw: counts of changes, of the snapshot before and after, and the bound after it."""
    return epoch_log(spark, epochs(spark, sf_dir))


def folders(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Folders by customer, year and status, and the files that are left in them: one for each expensive order."""
    orders = table(spark, sf_dir, "orders")
    leaf = F.concat_ws("/", F.lit("logs"), F.col("o_custkey").cast("string"), F.year("o_orderdate").cast("string"), F.col("o_orderstatus"))
    leaves = orders.select(leaf.alias("path"), "o_orderkey", "o_totalprice")
    levels = F.explode(F.array(*[F.substring_index("path", "/", n) for n in range(1, 5)]))
    dirs = leaves.select(levels.alias("path")).distinct()
    files = leaves.filter("o_totalprice > 400000").select(F.concat_ws("/", "path", F.col("o_orderkey").cast("string")).alias("path"))
    return dirs, files


@query("emptied_dirs", """
WITH RECURSIVE leaves AS (
  SELECT 'logs/' || o_custkey || '/' || year(o_orderdate) || '/' || o_orderstatus AS leaf, o_orderkey, o_totalprice FROM orders),
dirs AS (
  SELECT DISTINCT leaf AS path FROM leaves
  UNION SELECT array_to_string(string_split(path, '/')[:-2], '/') FROM dirs WHERE contains(path, '/')),
held AS (
  SELECT DISTINCT leaf AS path FROM leaves WHERE o_totalprice > 400000
  UNION SELECT array_to_string(string_split(path, '/')[:-2], '/') FROM held WHERE contains(path, '/'))
SELECT path FROM dirs WHERE path NOT IN (SELECT path FROM held)
""")
def emptied_dirs(spark, sf_dir):
    """Folders that hold no file at any depth, those that only hold empty folders included."""
    return L.emptied_dirs(*folders(spark, sf_dir))


@query("move_conflicts", """
WITH moves AS (
  SELECT 'in/' || o_custkey || '/' || o_orderkey AS key, CASE WHEN o_orderkey % 3 = 0 THEN 'in/' || (o_custkey) || '/' || (o_orderkey + 3)
         ELSE 'done/' || o_custkey || '-' || o_orderstatus END AS moved_to FROM orders),
real AS (SELECT * FROM moves WHERE key <> moved_to)
SELECT key, moved_to, 'same_target' AS conflict FROM real
WHERE moved_to IN (SELECT moved_to FROM real GROUP BY 1 HAVING count(DISTINCT key) > 1)
UNION ALL SELECT key, moved_to, 'occupied' FROM real WHERE moved_to IN (SELECT key FROM real)
""")
def move_conflicts(spark, sf_dir):
    """Archive moves of which several go to one place, or to one that another move leaves."""
    orders = table(spark, sf_dir, "orders")
    customer, order = F.col("o_custkey").cast("string"), F.col("o_orderkey")
    chained = F.concat_ws("/", F.lit("in"), customer, (order + 3).cast("string"))
    moved = F.when(order % 3 == 0, chained).otherwise(F.concat(F.lit("done/"), customer, F.lit("-"), F.col("o_orderstatus")))
    moves = orders.select(F.concat_ws("/", F.lit("in"), customer, order.cast("string")).alias("key"), moved.alias("moved_to"))
    return L.move_conflicts(stored(moves, "moves"))
