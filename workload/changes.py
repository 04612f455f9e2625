"""Harvest windows, change application and state."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from bindery.functions.keys import BATCH_FORMAT, overlap_from
from bindery.operators import changes as O, positions as P, state as T
from bindery.session import shared_path, stored
from bindery.streaming.apply import apply_stream, merged, stream_harvest
from workload.registry import query, table

SINCE, UNTIL = "2024-01-08 00:00:00", "2024-01-22 12:30:00"


def event_records(spark, sf_dir) -> DataFrame:
    sets = F.array(F.col("event_type"), F.concat(F.lit("user-"), F.col("user_id").cast("string")))
    return table(spark, sf_dir, "events").withColumn("sets", sets)


@query("harvest_window", f"""
SELECT event_id, user_id, event_type FROM events
WHERE ts BETWEEN TIMESTAMP '{SINCE}' AND TIMESTAMP '{UNTIL}' AND (event_type IN ('click', 'purchase') OR user_id = 7)
""")
def harvest_window(spark, sf_dir):
    found = O.harvest_window(
        event_records(spark, sf_dir), F.expr(f"timestamp_ntz'{SINCE}'"), F.expr(f"timestamp_ntz'{UNTIL}'"),
        ["click", "purchase", "user-7"], datestamp="ts",
    )
    return found.select("event_id", "user_id", "event_type")


@query("route_changes", """
SELECT event_id, CASE WHEN event_type = 'error' THEN 'deleted' ELSE 'new-updated' END AS change FROM events
""")
def route_changes(spark, sf_dir):
    return O.route_changes(event_records(spark, sf_dir), F.col("event_type") == "error").select("event_id", "change")


def daily_changes(spark, sf_dir) -> DataFrame:
    batch = F.concat_ws("/", F.date_format("ts", "yyyy-MM-dd"), F.col("user_id").cast("string"))
    return O.route_changes(event_records(spark, sf_dir), F.col("event_type") == "error").withColumn("batch", batch)


BATCHES = """
batches AS (
  SELECT strftime(ts, '%Y-%m-%d') || '/' || user_id AS batch,
         count(*) FILTER (event_type <> 'error') AS updated, count(*) FILTER (event_type = 'error') AS deleted
  FROM events GROUP BY 1)
"""


@query("change_counts", f"WITH {BATCHES} SELECT * FROM batches")
def change_counts(spark, sf_dir):
    return O.change_counts(daily_changes(spark, sf_dir), ["batch"])


@query("classify_batch", f"""
WITH {BATCHES}
SELECT batch, CASE WHEN updated > 0 AND deleted > 0 THEN 'updates_and_deletes_branch' WHEN updated > 0 THEN 'updates_only_branch'
                   WHEN deleted > 0 THEN 'deletes_only_branch' ELSE 'no_updates_no_deletes_branch' END AS branch
FROM batches
""")
def classify_batch(spark, sf_dir):
    return O.classify_batch(O.change_counts(daily_changes(spark, sf_dir), ["batch"])).select("batch", "branch")


@query("pre_post_counts", """
SELECT count(*) FILTER (ts < TIMESTAMP '2024-01-15 00:00:00') AS pre,
       count(*) FILTER (ts >= TIMESTAMP '2024-01-15 00:00:00') AS post FROM events
""")
def pre_post_counts(spark, sf_dir):
    phase = F.when(F.col("ts") < F.expr("timestamp_ntz'2024-01-15 00:00:00'"), "pre").otherwise("post")
    return O.pre_post_counts(table(spark, sf_dir, "events").withColumn("phase", phase))


# Orders are the snapshot. Line items are the changes: returned and finished ones delete their order.
PAYLOAD = ["stamp", "part", "supplier", "line", "price"]
ORDER = PAYLOAD


def order_snapshot(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("record_id"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("stamp"),
        F.lit(-1).cast("long").alias("part"), F.col("o_custkey").alias("supplier"), F.lit(0).alias("line"),
        F.col("o_totalprice").alias("price"),
    )


def line_changes(lines: DataFrame) -> DataFrame:
    gone = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
    return O.route_changes(lines, gone).select(
        F.col("l_orderkey").alias("record_id"), F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("stamp"),
        F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supplier"), F.col("l_linenumber").alias("line"),
        F.col("l_extendedprice").alias("price"), "change",
    )


CHANGES = """
snapshot AS (
  SELECT o_orderkey AS record_id, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS stamp, CAST(-1 AS BIGINT) AS part,
         o_custkey AS supplier, 0 AS line, o_totalprice AS price FROM orders),
changed AS (
  SELECT l_orderkey AS record_id, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS stamp, l_partkey AS part,
         l_suppkey AS supplier, l_linenumber AS line, l_extendedprice AS price,
         l_returnflag = 'R' AND l_linestatus = 'F' AS gone FROM lineitem),
latest AS (
  SELECT record_id, stamp, part, supplier, line, price FROM (
    SELECT *, row_number() OVER (PARTITION BY record_id
                                 ORDER BY stamp DESC, part DESC, supplier DESC, line DESC, price DESC) AS rn
    FROM changed WHERE NOT gone) WHERE rn = 1),
applied AS (
  SELECT * FROM (
    SELECT * FROM snapshot WHERE record_id NOT IN (SELECT record_id FROM latest)
    UNION ALL SELECT * FROM latest)
  WHERE record_id NOT IN (SELECT record_id FROM changed WHERE gone))
"""


@query("latest_change", f"WITH {CHANGES} SELECT * FROM latest")
def latest_change(spark, sf_dir):
    updates = line_changes(table(spark, sf_dir, "lineitem")).filter(F.col("change") == O.UPDATED).drop("change")
    return O.latest_change(updates, "record_id", ORDER)


@query("apply_changes", f"WITH {CHANGES} SELECT * FROM applied")
def apply_changes(spark, sf_dir):
    changes = line_changes(table(spark, sf_dir, "lineitem"))
    return O.apply_changes(order_snapshot(spark, sf_dir), changes, "record_id", PAYLOAD, ORDER)


@query("delete_keys", f"WITH {CHANGES} SELECT * FROM snapshot WHERE record_id NOT IN (SELECT record_id FROM changed WHERE gone)")
def delete_keys(spark, sf_dir):
    deletes = line_changes(table(spark, sf_dir, "lineitem")).filter(F.col("change") == O.DELETED)
    return O.delete_keys(order_snapshot(spark, sf_dir), deletes, "record_id")


@query("stream_apply", f"WITH {CHANGES} SELECT * FROM applied")
def stream_apply(spark, sf_dir):
    schema = table(spark, sf_dir, "lineitem").schema
    # The file source watches folders and patterns, so the table is named as a pattern.
    lines = stream_harvest(spark, f"{sf_dir}/lineitem.parque[t]", schema)
    root = shared_path(spark, "stream")
    apply_stream(line_changes(lines), root, "record_id", PAYLOAD, ORDER).awaitTermination()
    return merged(order_snapshot(spark, sf_dir), root, "record_id")


REPLAYED = """
, recent AS (
  SELECT * FROM changed
  WHERE stamp >= (SELECT strftime(CAST(max(l_shipdate) AS TIMESTAMP) - INTERVAL 24 HOUR, '%Y-%m-%d %H:%M:%S') FROM lineitem)),
relatest AS (
  SELECT record_id, stamp, part, supplier, line, price FROM (
    SELECT *, row_number() OVER (PARTITION BY record_id
                                 ORDER BY stamp DESC, part DESC, supplier DESC, line DESC, price DESC) AS rn
    FROM recent WHERE NOT gone) WHERE rn = 1)
SELECT * FROM (
  SELECT * FROM applied WHERE record_id NOT IN (SELECT record_id FROM relatest)
  UNION ALL SELECT * FROM relatest)
WHERE record_id NOT IN (SELECT record_id FROM recent WHERE gone)
"""


@query("overlap_replay", f"WITH {CHANGES} {REPLAYED}")
def overlap_replay(spark, sf_dir):
    """The whole change set, then once more what falls into the overlap before the newest batch.

    The replayed window is harvested as it is, so a key that was deleted before it comes back with its update.
    """
    lines = table(spark, sf_dir, "lineitem")
    changes = line_changes(lines)
    once = stored(O.apply_changes(order_snapshot(spark, sf_dir), changes, "record_id", PAYLOAD, ORDER), "once")
    # One row: the start of the next harvest, by the stamp of the newest batch. As a constant it reaches the scan.
    newest = lines.agg(F.date_format(F.max("l_shipdate"), BATCH_FORMAT).alias("stamp"))
    since = newest.select(overlap_from(F.col("stamp"))).first()[0]
    window = O.harvest_window(lines, since=F.lit(since).cast(lines.schema["l_shipdate"].dataType), datestamp="l_shipdate")
    return O.apply_changes(once, line_changes(window), "record_id", PAYLOAD, ORDER)


STATE = """
rows AS (
  SELECT event_type || ':' || user_id AS key, CASE WHEN value < 5 THEN '' ELSE printf('%.2f', value) END AS value, event_id AS version FROM events
  UNION ALL SELECT 'region:' || r_regionkey, r_name, CAST(0 AS BIGINT) FROM region),
last AS (SELECT key, arg_max(value, version) AS value, max(version) AS version FROM rows GROUP BY key)
"""


def event_state(spark, sf_dir) -> DataFrame:
    stored_rows = table(spark, sf_dir, "region").select(
        F.concat(F.lit("region:"), F.col("r_regionkey").cast("string")).alias("key"), F.col("r_name").alias("value"),
        F.lit(0).cast("long").alias("version"),
    )
    updates = table(spark, sf_dir, "events").select(
        F.concat_ws(":", "event_type", F.col("user_id").cast("string")).alias("key"),
        F.when(F.col("value") < 5, "").otherwise(F.format_string("%.2f", "value")).alias("value"),
        F.col("event_id").alias("version"),
    )
    return T.upsert_state(stored_rows, updates)


@query("state_upsert", f"WITH {STATE} SELECT key, value, version FROM last")
def state_upsert(spark, sf_dir):
    return event_state(spark, sf_dir)


@query("state_read", f"""
WITH {STATE}, wanted AS (SELECT 'click:' || c_custkey AS key FROM customer)
SELECT key, CASE WHEN value IS NULL OR value IN ('', 'None') THEN 'default' ELSE value END AS value
FROM wanted LEFT JOIN last USING (key)
""")
def state_read(spark, sf_dir):
    wanted = table(spark, sf_dir, "customer").select(F.concat(F.lit("click:"), F.col("c_custkey").cast("string")).alias("key"))
    return T.read_state(event_state(spark, sf_dir), "default", wanted)


RUNS = """
runs AS (
  SELECT 'user' || user_id AS target, strftime(min(ts), '%Y-%m-%dT%H:%M:%SZ') AS f,
         CASE WHEN count(*) FILTER (event_type = 'signup') > 10 THEN NULL ELSE strftime(max(ts), '%Y-%m-%dT%H:%M:%SZ') END AS u,
         count(*) FILTER (event_type = 'purchase' AND value > 100) AS updated, count(*) FILTER (event_type = 'error' AND value > 100) AS deleted
  FROM events GROUP BY user_id)
"""
LOGICAL = "2024-02-01T00:00:00Z"


def event_runs(spark, sf_dir) -> DataFrame:
    iso = lambda column: F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    kind, value = F.col("event_type"), F.col("value")
    runs = table(spark, sf_dir, "events").groupBy(F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("target")).agg(
        iso(F.min("ts")).alias("harvest_from"), iso(F.max("ts")).alias("last"),
        F.count_if(kind == "signup").alias("signups"),
        F.count_if((kind == "purchase") & (value > 100)).alias("updated"),
        F.count_if((kind == "error") & (value > 100)).alias("deleted"),
    )
    return runs.withColumns(
        {"harvest_until": F.when(F.col("signups") <= 10, F.col("last")), "logical_time": F.lit(LOGICAL)}
    )


@query("harvest_bounds", f"""
WITH {RUNS}
SELECT target || '_FROM' AS key, coalesce(u, '{LOGICAL}') AS value FROM runs
UNION ALL SELECT target || '_LAST_FROM', f FROM runs
""")
def harvest_bounds(spark, sf_dir):
    return T.harvest_bounds(event_runs(spark, sf_dir))


@query("high_watermark", f"""
WITH {RUNS}, old AS (SELECT 'user' || c_custkey || '_FROM' AS key, 'never' AS value FROM customer),
new AS (SELECT target || '_FROM' AS key, coalesce(u, '{LOGICAL}') AS value FROM runs WHERE updated > 0 OR deleted > 0
        UNION ALL SELECT target || '_LAST_FROM', f FROM runs WHERE updated > 0 OR deleted > 0)
SELECT key, value FROM new UNION ALL SELECT key, value FROM old WHERE key NOT IN (SELECT key FROM new)
""")
def high_watermark(spark, sf_dir):
    """Bounds move on only for runs that changed something."""
    old = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("user"), F.col("c_custkey").cast("string"), F.lit("_FROM")).alias("key"),
        F.lit("never").alias("value"), F.lit(1).cast("long").alias("version"),
    )
    runs = event_runs(spark, sf_dir)
    return T.advance_bounds(old, runs, runs, F.lit(2).cast("long")).select("key", "value")


@query("split_balanced", "SELECT doc_id, lang, CAST(ntile(3) OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS BIGINT) AS chunk FROM documents")
def split_balanced(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return P.split_balanced(docs, 3, ["doc_id"], by=["lang"])


@query("split_whole", "SELECT o_orderkey, CAST(ntile(7) OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS BIGINT) AS chunk FROM orders")
def split_whole(spark, sf_dir):
    """One group over the whole table."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return P.split_balanced(orders, 7, ["o_totalprice", "o_orderkey"]).select("o_orderkey", "chunk")
