"""Ledgers made from events: one per event type, holding user names in event order."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from bindery.operators import ledger as L
from workload.registry import query, table

NAME = "CASE WHEN value < 3 THEN '' WHEN value < 5 THEN 'None' ELSE 'user-' || user_id END"


def pushes(spark, sf_dir) -> DataFrame:
    value = F.col("value")
    name = F.when(value < 3, "").when(value < 5, "None").otherwise(F.concat(F.lit("user-"), F.col("user_id").cast("string")))
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("ledger"), F.col("event_id").alias("pos"), name.alias("value")
    )


def held(spark, sf_dir) -> DataFrame:
    """What is stored before the pushes: one ledger with a repeated value."""
    return table(spark, sf_dir, "nation").select(
        F.lit("click").alias("ledger"), F.col("n_nationkey").cast("long").alias("pos"),
        F.concat(F.lit("user-"), F.col("n_regionkey").cast("string")).alias("value"),
    )


HELD = "held AS (SELECT 'click' AS ledger, n_nationkey AS p, 'user-' || n_regionkey AS value FROM nation)"


@query("ledger_push", f"""
WITH {HELD}, pushed AS (SELECT event_type AS ledger, event_id AS p, {NAME} AS value FROM events),
new AS (SELECT ledger, min(p) AS p, value FROM pushed WHERE value <> '' AND (ledger, value) NOT IN (SELECT (ledger, value) FROM held) GROUP BY ledger, value),
joined AS (SELECT 0 AS n, * FROM held UNION ALL SELECT 1, * FROM new)
SELECT ledger, row_number() OVER (PARTITION BY ledger ORDER BY n, p) AS pos, value FROM joined
""")
def ledger_push(spark, sf_dir):
    return L.push(held(spark, sf_dir), pushes(spark, sf_dir))


@query("ledger_append", f"""
WITH {HELD}, pushed AS (SELECT event_type AS ledger, event_id AS p, {NAME} AS value FROM events),
joined AS (SELECT 0 AS n, * FROM held UNION ALL SELECT 1, * FROM pushed)
SELECT ledger, row_number() OVER (PARTITION BY ledger ORDER BY n, p) AS pos, value FROM joined
""")
def ledger_append(spark, sf_dir):
    """Repeats and blanks are kept, so a ledger grows with the table."""
    return L.push(held(spark, sf_dir), pushes(spark, sf_dir), unique=False, skip_blank=False)


INCLUDED = ["user-3", "user-30"]
MATCHING = "user-1[0-9]$"


def items(spark, sf_dir) -> DataFrame:
    value = F.col("value")
    failure = F.when(value > 40, F.concat(F.lit("Could not find collection : user-"), F.col("user_id").cast("string"))).otherwise("500:Server Error")
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("ledger"), F.col("event_id").alias("pos"),
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("name"), (value < 20).alias("ok"), failure.alias("failure"),
    )


PROCESSED = """
processed AS (
  SELECT ledger, pos, name,
         CASE WHEN rn <= 3 OR listed OR matched THEN 'SKIPPED' WHEN value < 20 THEN 'OK' ELSE 'FAILED' END AS status,
         CASE WHEN rn <= 3 THEN 'skip_from_last' WHEN listed THEN 'skip_included' WHEN matched THEN 'skip_matching'
              WHEN value < 20 THEN NULL WHEN value > 40 THEN 'Could not find collection : ' || name ELSE '500:Server Error' END AS reason
  FROM (SELECT event_type AS ledger, event_id AS pos, 'user-' || user_id AS name, value,
               row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) AS rn,
               user_id IN (3, 30) AS listed, regexp_matches('user-' || user_id, '^user-1[0-9]$') AS matched
        FROM events))
"""


def processed(spark, sf_dir) -> DataFrame:
    return L.prune_status(items(spark, sf_dir), 3, INCLUDED, MATCHING)


@query("prune_status", f"WITH {PROCESSED} SELECT ledger, pos, name, status, coalesce(reason, '') AS reason FROM processed")
def prune_status(spark, sf_dir):
    return processed(spark, sf_dir).withColumn("reason", F.coalesce("reason", F.lit("")))


@query("prune_listed", f"""
WITH nations AS (SELECT 'user-' || n_nationkey AS name FROM nation),
ranked AS (SELECT event_type AS ledger, event_id AS pos, 'user-' || user_id AS name, value,
                  row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) AS rn FROM events)
SELECT ledger, pos, CASE WHEN rn <= 1 OR name IN (SELECT name FROM nations) THEN 'SKIPPED' WHEN value < 20 THEN 'OK' ELSE 'FAILED' END AS status
FROM ranked
""")
def prune_listed(spark, sf_dir):
    """The skip list is itself a table."""
    listed = table(spark, sf_dir, "nation").select(F.concat(F.lit("user-"), F.col("n_nationkey").cast("string")).alias("name"))
    return L.prune_status(items(spark, sf_dir), 1, listed).select("ledger", "pos", "status")


@query("status_tally", f"""
WITH {PROCESSED} SELECT status, coalesce(reason, '') AS reason, count(*) AS items FROM processed GROUP BY ALL
""")
def status_tally(spark, sf_dir):
    return L.status_tally(processed(spark, sf_dir)).withColumn("reason", F.coalesce("reason", F.lit("")))


@query("ledger_remaining", f"""
WITH {PROCESSED}
SELECT ledger, row_number() OVER (PARTITION BY ledger ORDER BY CASE status WHEN 'FAILED' THEN 0 ELSE 1 END, pos) AS pos, name AS value
FROM processed
WHERE status = 'SKIPPED' OR (status = 'FAILED' AND NOT starts_with(reason, 'Could not find collection'))
""")
def ledger_remaining(spark, sf_dir):
    return L.remaining(processed(spark, sf_dir))


@query("prune_outcomes", f"""
WITH {PROCESSED} SELECT ledger, pos, name, status FROM processed WHERE status <> 'SKIPPED'
""")
def prune_outcomes(spark, sf_dir):
    """Both follow-up frames, joined for the comparison."""
    done, failed = L.outcomes(processed(spark, sf_dir))
    return done.unionByName(failed).select("ledger", "pos", "name", "status")


@query("stored_ledgers", """
SELECT ledger, place + 1 AS pos, value FROM (
  SELECT ledger, unnest(range(len(l))) AS place, unnest(l) AS value FROM (
    SELECT event_id AS ledger, [event_type, 'user-' || user_id, event_type] AS l FROM events WHERE value >= 5))
""")
def stored_ledgers(spark, sf_dir):
    """Ledgers held as list text, one to an event."""
    entries = F.concat(
        F.lit('["'), F.col("event_type"), F.lit('", "user-'), F.col("user_id").cast("string"), F.lit('", "'), F.col("event_type"), F.lit('"]')
    )
    state = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("key"), F.when(F.col("value") < 3, "").when(F.col("value") < 5, "None").otherwise(entries).alias("value")
    )
    return L.read_ledgers(state)
