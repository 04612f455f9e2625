"""Inventories of files made from orders, events and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from bindery.functions import keys as K
from bindery.operators import files as O
from bindery.sources.drops import under_prefix
from workload.registry import query, table


def order_files(spark, sf_dir) -> DataFrame:
    """One file per order: most are plain batches, urgent ones boundwith batches, pending ones neither."""
    stamp = F.date_format("o_orderdate", "yyyyMMddHH")
    tail = F.concat(F.lit("_"), F.col("o_orderkey").cast("string"), F.lit("_new_1.xml.tar.gz"))
    stem = (
        F.when(F.col("o_orderstatus") == "P", "listing__")
        .when(F.col("o_orderpriority") == "1-URGENT", K.BOUNDWITH_STEM)
        .otherwise(K.STEM)
    )
    return table(spark, sf_dir, "orders").select(
        F.concat(stem, stamp, tail).alias("key"), "o_orderkey", "o_orderstatus", "o_orderpriority", stamp.alias("stamp")
    )


ORDER_FILES = """
files AS (
  SELECT CASE WHEN o_orderstatus = 'P' THEN 'listing__'
              WHEN o_orderpriority = '1-URGENT' THEN 'alma_bibs__boundwith2_'
              ELSE 'alma_bibs__' END
         || strftime(o_orderdate, '%Y%m%d%H') || '_' || o_orderkey || '_new_1.xml.tar.gz' AS key,
         o_orderkey, o_orderstatus, o_orderpriority, strftime(o_orderdate, '%Y%m%d%H') AS stamp
  FROM orders)
"""


@query("listed_under_prefix", """
SELECT o_orderkey,
       starts_with(key, 'F/') AND position('/' IN substr(key, 3)) = 0 AS direct,
       starts_with(key, 'F/') AS below
FROM (SELECT o_orderkey, o_orderstatus || '/' || CASE WHEN o_orderpriority = '5-LOW' THEN 'old/' ELSE '' END
             || o_orderkey || '.xml' AS key FROM orders)
""")
def listed_under_prefix(spark, sf_dir):
    folder = F.when(F.col("o_orderpriority") == "5-LOW", "old/").otherwise("")
    key = F.concat("o_orderstatus", F.lit("/"), folder, F.col("o_orderkey").cast("string"), F.lit(".xml"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", under_prefix(key, "F/", "/").alias("direct"), under_prefix(key, "F/", "").alias("below")
    )


@query("newest_batch_files", f"""
WITH {ORDER_FILES},
newest AS (SELECT max(CAST(split_part(key, '_', 4) AS BIGINT)) AS stamp FROM files WHERE starts_with(key, 'alma_bibs__20'))
SELECT key FROM files WHERE starts_with(key, 'alma_bibs__' || (SELECT stamp FROM newest))
""")
def newest_batch_files(spark, sf_dir):
    return O.batch_candidates(order_files(spark, sf_dir)).select("key")


@query("newest_boundwith_files", f"""
WITH {ORDER_FILES},
newest AS (SELECT max(CAST(split_part(key, '_', 5) AS BIGINT)) AS stamp
           FROM files WHERE starts_with(key, 'alma_bibs__boundwith2_20'))
SELECT key FROM files WHERE starts_with(key, 'alma_bibs__boundwith2_' || (SELECT stamp FROM newest))
""")
def newest_boundwith_files(spark, sf_dir):
    return O.batch_candidates(order_files(spark, sf_dir), K.BOUNDWITH_STEM).select("key")


@query("newest_batch", f"""
WITH {ORDER_FILES}
SELECT max(CAST(split_part(key, '_', 4) AS BIGINT)) AS newest FROM files WHERE starts_with(key, 'alma_bibs__20')
""")
def newest_batch(spark, sf_dir):
    return O.newest_batch(O.with_prefix(order_files(spark, sf_dir), "alma_bibs__20"))


@query("oldest_datestamp", r"""
SELECT strftime(strptime(min(regexp_extract(key, 'alma_bibs__(.*)_.*', 1)), '%Y-%m-%dT%H:%M:%Sz'), '%Y-%m-%d %H:%M:%S') AS oldest
FROM (SELECT 'almasftp/alma_bibs__' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'z_' || event_id AS key FROM events)
""")
def oldest_datestamp(spark, sf_dir):
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'z'")
    keys = table(spark, sf_dir, "events").select(
        F.concat(F.lit("almasftp/alma_bibs__"), stamp, F.lit("_"), F.col("event_id").cast("string")).alias("key")
    )
    oldest = O.oldest_datestamp(keys, "almasftp/")
    return oldest.select(F.date_format("oldest", "yyyy-MM-dd HH:mm:ss").alias("oldest"))


@query("key_rewrites", f"""
WITH {ORDER_FILES}
SELECT key,
       replace(replace('almasftp/' || key, '.tar.gz', ''), 'almasftp/alma_bibs__', 'almasftp/prepared/alma_bibs__') AS prepared,
       'dspace/' || replace('in/' || stamp || '/' || key, '/', '-') || '.xml' AS flat,
       'almasftp/' || key AS landing,
       './/' || key AS listing,
       'archive/' || stamp || '/' || key AS archived
FROM files WHERE starts_with('almasftp/' || key, 'almasftp/alma_bibs__') AND ends_with(key, '.tar.gz')
""")
def key_rewrites(spark, sf_dir):
    files = order_files(spark, sf_dir).withColumnRenamed("key", "name")
    files = files.withColumn("key", F.concat(F.lit("almasftp/"), "name"))
    chosen = O.prepared_keys(files, "almasftp/alma_bibs__", ".tar.gz", "almasftp/prepared")
    nested = F.concat(F.lit("in/"), "stamp", F.lit("/"), "name")
    return chosen.select(
        F.col("name").alias("key"), F.col("dest_key").alias("prepared"), K.flat_name(nested, "dspace/").alias("flat"),
        K.landing_key(F.col("name"), "almasftp/").alias("landing"), K.listing_path(F.col("name"), "./").alias("listing"),
        K.archive_key(F.col("name"), F.col("stamp")).alias("archived"),
    )


FOLDERS = """
keyed AS (
  SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'new-updated/deleted/new-updated-' WHEN 'O' THEN 'deleted/' ELSE 'other/' END
         || o_orderkey || '.xml' AS key FROM orders)
"""


def folder_files(spark, sf_dir) -> DataFrame:
    folder = (
        F.when(F.col("o_orderstatus") == "F", "new-updated/deleted/new-updated-")
        .when(F.col("o_orderstatus") == "O", "deleted/").otherwise("other/")
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat(folder, F.col("o_orderkey").cast("string"), F.lit(".xml")).alias("key")
    )


@query("relocated_files", f"""
WITH {FOLDERS},
moved AS (SELECT o_orderkey, key,
                 regexp_replace(regexp_replace(key, 'new-updated', 'processed-new-updated'), 'deleted', 'processed-deleted') AS moved_to
          FROM keyed)
SELECT o_orderkey, key, moved_to FROM moved WHERE key <> moved_to
""")
def relocated_files(spark, sf_dir):
    return O.relocations(folder_files(spark, sf_dir))


@query("unprocessed_files", f"""
WITH {FOLDERS}
SELECT o_orderkey, key FROM keyed WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
""")
def unprocessed_files(spark, sf_dir):
    files = folder_files(spark, sf_dir)
    returned = table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R").select("l_orderkey")
    processed = returned.distinct().join(files, F.col("l_orderkey") == F.col("o_orderkey")).select("key")
    return O.unprocessed(files, processed).select("o_orderkey", "key")


@query("expired_files", """
SELECT key, strftime(ts, '%Y-%m-%d %H:%M:%S') AS modified
FROM (SELECT ts, CASE event_type WHEN 'click' THEN CAST(event_id AS VARCHAR)
                 ELSE event_type || '/' || user_id || '/' || event_id END AS key FROM events)
WHERE floor(date_diff('microsecond', ts, TIMESTAMP '2024-02-20 12:00:00') / 86400000000) > 30
  AND len(string_split(key, '/')) >= 2
""")
def expired_files(spark, sf_dir):
    key = F.when(F.col("event_type") == "click", F.col("event_id").cast("string")).otherwise(
        F.concat_ws("/", "event_type", F.col("user_id").cast("string"), F.col("event_id").cast("string"))
    )
    files = table(spark, sf_dir, "events").select(key.alias("key"), F.col("ts").alias("mtime"))
    gone = O.expired_files(files, F.expr("timestamp_ntz'2024-02-20 12:00:00'"), least=2)
    return gone.select("key", F.date_format("mtime", "yyyy-MM-dd HH:mm:ss").alias("modified"))


@query("empty_dirs", """
SELECT 'orders/' || o_orderkey AS path FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
""")
def empty_dirs(spark, sf_dir):
    dirs = table(spark, sf_dir, "orders").select(F.concat(F.lit("orders/"), F.col("o_orderkey").cast("string")).alias("path"))
    entries = table(spark, sf_dir, "lineitem").select(
        F.concat_ws("/", F.lit("orders"), F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("path")
    )
    return O.empty_dirs(dirs, entries)


@query("records_per_file", """
SELECT coalesce(source, '(all)') AS src_key, count(*) AS records FROM documents GROUP BY ROLLUP (source)
""")
def records_per_file(spark, sf_dir):
    counted = O.records_per_file(table(spark, sf_dir, "documents").withColumnRenamed("source", "src_key"))
    return counted.select(F.coalesce("src_key", F.lit("(all)")).alias("src_key"), "records")


@query("files_moved", f"WITH {ORDER_FILES} SELECT stamp, count(*) AS moved FROM files GROUP BY stamp")
def files_moved(spark, sf_dir):
    return O.files_moved(order_files(spark, sf_dir), "stamp")


@query("count_docs", "SELECT count(*) AS num_found FROM documents")
def count_docs(spark, sf_dir):
    return O.count_docs(table(spark, sf_dir, "documents"))
