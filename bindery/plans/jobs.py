"""The four jobs: full rebuild, incremental harvest, thesis mapping, ledger prune."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from bindery.operators import buckets
from bindery.operators.changes import (
    apply_net, change_counts, classify_batch, harvest, net_changes, route_changes,
)
from bindery.operators.ledger import prune_status, push, remaining
from bindery.operators.lookup import enrich_with_parents, explode_children
from bindery.operators.state import advance_bounds
from bindery.plans.thesis import xoai_to_marc
from bindery.session import stored
from bindery.sinks.files import write_cleaned, write_marcxml
from bindery.sources.archives import read_archives
from bindery.sources.xml import read_oai_marcxml, read_xoai
from bindery.streaming.epochs import commit_batch


def full_rebuild(spark: SparkSession, records_path: str, parents_path: str, out: str) -> DataFrame:
    """Unpack, enrich and write all records; returns what was written."""
    prepared = enrich_with_parents(read_archives(spark, records_path), explode_children(read_archives(spark, parents_path)))
    prepared.write.parquet(out)
    return spark.read.schema(prepared.schema).parquet(out)


def harvested_changes(
    spark: SparkSession, harvested: str, parents: str, since: Column, until: Column, sets: Sequence[str] | None = None
) -> DataFrame:
    """Records of the window, enriched and routed. A deleted record has its id from the header."""
    lookup = explode_children(read_oai_marcxml(spark, parents))
    records = read_oai_marcxml(spark, harvested)
    records = harvest(records, since, until, sets, transform=lambda df: enrich_with_parents(df, lookup))
    return route_changes(
        records.withColumn("record_id", F.coalesce("record_id", F.substring_index("oai_id", ":", -1))), F.col("deleted")
    )


def harvest_into(
    spark: SparkSession, harvested: str, parents: str, root: str, state: DataFrame, target: str, since: str, until: str,
    version: int, routed: str, sets: Sequence[str] | None = None,
) -> tuple[dict, DataFrame]:
    """The whole incremental run on the bucketed snapshot at ``root``.

    Harvests and enriches the window, writes the routed files below ``routed``, applies them, counts before and after, and
    commits all that as one version. Returns its record and the state that follows, whose bounds have moved only if the
    committed batch changed something. ``version`` numbers the run: a rerun of a committed one changes nothing.
    """
    window = [F.lit(bound).cast("timestamp_ntz") for bound in (since, until)]
    changes = harvested_changes(spark, harvested, parents, *window, sets)
    schema = buckets.read_snapshot(spark, root).columns
    payload = [name for name in schema if name != "record_id"]
    record = commit_batch(changes, root, version, payload, ["datestamp", "src_key", "rec_pos"], "datestamp", routed)
    run = spark.createDataFrame([(target, since, until, until)], "target string, harvest_from string, harvest_until string, logical_time string")
    counts = spark.createDataFrame([(target, record["updated"], record["deleted"])], "target string, updated long, deleted long")
    return record, advance_bounds(state, run, counts, F.lit(version).cast("long"))


def incremental_harvest(
    spark: SparkSession, harvested: str, parents: str, snapshot: DataFrame, since: Column, until: Column,
    sets: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """New snapshot, and the counts and branch of the batch."""
    changes = stored(harvested_changes(spark, harvested, parents, since, until, sets), "changes")
    counts = classify_batch(
        change_counts(changes.withColumn("batch", F.lit("harvest")), ["batch"])
    )
    payload = [name for name in snapshot.columns if name != "record_id"]
    net = stored(net_changes(changes, "record_id", payload, ["datestamp", "src_key", "rec_pos"]), "net")
    return apply_net(snapshot, net, "record_id"), counts


def thesis_mapping(
    spark: SparkSession, path: str, out: str, run_date: Column, cleaned: str | None = None, records_per_file: int = 1000
) -> DataFrame:
    """Read repository records, map them, and write them as XML. With ``cleaned``, keep that form too."""
    records = read_xoai(spark, path).filter(~F.col("deleted"))
    if cleaned:
        write_cleaned(records, cleaned, records_per_file)
    mapped = xoai_to_marc(records, run_date, ["src_key", "rec_pos", "oai_id"])
    write_marcxml(mapped.withColumnRenamed("oai_id", "airflow_record_id"), out, records_per_file=records_per_file)
    return mapped


def ledger_prune(ledger: DataFrame, pushed: DataFrame, outcomes: DataFrame, keep_last: int, **rules) -> DataFrame:
    """Push new values, prune, and return the ledger that is left.

    ``outcomes`` has name, ok, failure, and ledger if names recur in several. An item that nobody attempted stays.
    """
    names = push(ledger, pushed).withColumnRenamed("value", "name")
    items = names.join(outcomes, [c for c in ("ledger", "name") if c in outcomes.columns], "left")
    return remaining(prune_status(stored(items, "items"), keep_last, **rules))
