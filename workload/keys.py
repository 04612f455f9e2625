"""Names, stamps, stored values and expectations."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindery.functions import keys as K, values as V
from bindery.operators import checks as C, snapshots as S
from workload.registry import query, table

CONFIGURED = """CASE WHEN s_acctbal < 0 THEN '' WHEN s_acctbal < 2000 THEN 'None' WHEN s_acctbal < 4000 THEN NULL
                     ELSE 'fixed-' || s_suppkey END"""


def suppliers(spark, sf_dir):
    balance = F.col("s_acctbal")
    configured = F.when(balance < 0, "").when(balance < 2000, "None").when(
        balance >= 4000, F.concat(F.lit("fixed-"), F.col("s_suppkey").cast("string"))
    )
    return table(spark, sf_dir, "supplier").withColumn("configured", configured)


@query("snapshot_names", f"""
SELECT s_suppkey,
       CASE WHEN configured IS NULL OR configured IN ('', 'None') THEN s_name || '.' || s_nationkey || '-2024-01-30_23-05-09'
            ELSE configured END AS versioned,
       CASE WHEN configured IS NULL OR configured IN ('', 'None') THEN s_name || '-2024-01-30_23-05-09'
            ELSE configured END AS plain
FROM (SELECT *, {CONFIGURED} AS configured FROM supplier)
""")
def snapshot_names(spark, sf_dir):
    stamp = K.namespace_stamp(F.expr("timestamp_ntz'2024-01-30 23:05:09'"))
    configured, name = F.col("configured"), F.col("s_name")
    return suppliers(spark, sf_dir).select(
        "s_suppkey",
        K.snapshot_name(configured, name, stamp, F.col("s_nationkey").cast("string")).alias("versioned"),
        K.snapshot_name(configured, name, stamp).alias("plain"),
    )


@query("namespace_stamps", "SELECT event_id, strftime(ts, '%Y-%m-%d_%H-%M-%S') AS namespace FROM events")
def namespace_stamps(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", K.namespace_stamp(F.col("ts")).alias("namespace"))


@query("missing_snapshots", """
SELECT DISTINCT 'catalog-' || p_brand || '-' || p_size AS name FROM part
WHERE 'catalog-' || p_brand || '-' || p_size NOT IN (SELECT 'catalog-Brand#' || s_nationkey || '-' || s_suppkey FROM supplier)
""")
def missing_snapshots(spark, sf_dir):
    wanted = table(spark, sf_dir, "part").select(
        F.concat(F.lit("catalog-"), "p_brand", F.lit("-"), F.col("p_size").cast("string")).alias("name")
    ).distinct()
    existing = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("catalog-Brand#"), F.col("s_nationkey").cast("string"), F.lit("-"), F.col("s_suppkey").cast("string")).alias("name")
    )
    return S.missing_snapshots(wanted, existing)


@query("overlap_from", """
SELECT o_orderkey, strftime(o_orderdate - INTERVAL 24 HOURS, '%Y-%m-%dT%H:00:00Z') AS harvest_from FROM orders
""")
def overlap_from(spark, sf_dir):
    stamp = F.date_format("o_orderdate", K.BATCH_FORMAT).cast("long")
    return table(spark, sf_dir, "orders").select("o_orderkey", K.overlap_from(stamp).alias("harvest_from"))


@query("num_found", """
SELECT event_id, CASE event_type WHEN 'error' THEN 0 WHEN 'signup' THEN 0
                 ELSE CAST(props->>'$.k' AS BIGINT) END AS num_found
FROM events
""")
def num_found(spark, sf_dir):
    whole = F.concat(F.lit('{"response":{"numFound":'), F.get_json_object("props", "$.k"), F.lit(',"docs":[]}}'))
    response = F.when(F.col("event_type") == "error", F.lit("<html>")).when(
        F.col("event_type") == "signup", F.col("props")
    ).otherwise(whole)
    return table(spark, sf_dir, "events").select("event_id", V.num_found(response).alias("num_found"))


@query("failure_reason", """
SELECT event_id, CASE event_type WHEN 'error' THEN 'Could not find collection : ' || user_id
                 ELSE '5' || (props->>'$.k') || ':' || event_type END AS reason
FROM events
""")
def failure_reason(spark, sf_dir):
    error = F.concat(
        F.lit('{"error":{"msg":"Could not find collection : '), F.col("user_id").cast("string"), F.lit('","code":400}}')
    )
    body = F.when(F.col("event_type") == "error", error).when(F.col("event_type") == "click", F.lit("not json")).otherwise(F.col("props"))
    status = F.concat(F.lit("5"), F.get_json_object("props", "$.k"))
    return table(spark, sf_dir, "events").select(
        "event_id", V.failure_reason(body, status, F.col("event_type")).alias("reason")
    )


@query("parse_list", """
SELECT event_id, item_pos, item FROM (
  SELECT event_id, unnest(range(len(items))) AS item_pos, unnest(items) AS item FROM (
    SELECT event_id, [event_type, props->>'$.k', 'u' || user_id] AS items FROM events WHERE event_type NOT IN ('error', 'signup', 'view')))
""")
def parse_list(spark, sf_dir):
    kind = F.col("event_type")
    items = F.concat(F.lit("['"), kind, F.lit("', '"), F.get_json_object("props", "$.k"), F.lit("', 'u"), F.col("user_id").cast("string"), F.lit("']"))
    text = F.when(kind == "error", "").when(kind == "signup", "None").when(kind != "view", items)
    rows = table(spark, sf_dir, "events").select("event_id", V.parse_list(text).alias("items"))
    return rows.select("event_id", F.posexplode("items").alias("item_pos", "item")).select(
        "event_id", F.col("item_pos").cast("long").alias("item_pos"), "item"
    )


@query("expectations", f"""
WITH named AS (SELECT s_suppkey, s_name, {CONFIGURED} AS configured FROM supplier)
SELECT 'not_blank' AS rule, CAST(s_suppkey AS VARCHAR) AS subject, coalesce(configured, 'null') AS detail
FROM named WHERE configured IS NULL OR configured IN ('', 'None')
UNION ALL
SELECT 'different', CAST(p_partkey AS VARCHAR), p_type FROM part WHERE p_type = split_part(upper(p_name), ' ', 1)
UNION ALL
SELECT 'rows', CAST(o_orderkey AS VARCHAR), 'no rows' FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
UNION ALL
SELECT 'no_failures', CAST(event_id AS VARCHAR), '5' || (props->>'$.k') || ':error' FROM events WHERE event_type = 'error'
""")
def expectations(spark, sf_dir):
    parts = table(spark, sf_dir, "part").withColumn("alias", F.upper(F.substring_index("p_name", " ", 1)))
    counted = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("rows"))
    lines = table(spark, sf_dir, "orders").join(counted, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    processed = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("name"),
        F.when(F.col("event_type") == "error", "FAILED").otherwise("OK").alias("status"),
        F.concat(F.lit("5"), F.get_json_object("props", "$.k"), F.lit(":error")).alias("reason"),
    )
    found = C.expect_not_blank(suppliers(spark, sf_dir), "configured", "s_suppkey")
    found = found.unionByName(C.expect_different(parts, "p_type", "alias", "p_partkey"))
    found = found.unionByName(C.expect_rows(lines, "rows", "o_orderkey"))
    return found.unionByName(C.expect_no_failures(processed))
