"""Parent-to-child lookup and its join onto records."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from bindery.functions.fields import append_fields, parent_fields, subfield_values, trimmed_id, valid_child_id
from bindery.functions.packed_xml import pack_fields, parse_field, split_fields
from bindery.session import stored


def explode_children(records: DataFrame) -> DataFrame:
    """One row per valid child id of a parent. A child may appear several times.

    ``ord`` is the place in the lookup: file, record in the file, child in the record.
    """
    # The inherited fields are made once per parent, before its children are exploded.
    parents = records.select(
        "src_key", "rec_pos", F.col("record_id").alias("parent_id"),
        parent_fields(F.col("record_id"), F.col("datafield")).alias("fields"),
        subfield_values(F.col("datafield"), "774", "w").alias("ids"),
    )
    return _child_rows(parents, "fields")


def _child_rows(parents: DataFrame, inherited: str) -> DataFrame:
    listed = parents.select(
        "src_key", "rec_pos", "parent_id", inherited, F.posexplode("ids").alias("child_pos", "raw_id")
    )
    return listed.filter(valid_child_id(F.col("raw_id"))).select(
        trimmed_id(F.col("raw_id")).try_cast("long").alias("child_id"),
        F.col("parent_id").try_cast("long").alias("parent_id"),
        inherited,
        F.struct("src_key", "rec_pos", "child_pos").alias("ord"),
    )


def build_lookup(records: DataFrame) -> DataFrame:
    """Lookup rows with the inherited fields packed as in the lookup file."""
    parents = records.select(
        "src_key", "rec_pos", F.col("record_id").alias("parent_id"),
        pack_fields(parent_fields(F.col("record_id"), F.col("datafield"))).alias("parent_xml"),
        subfield_values(F.col("datafield"), "774", "w").alias("ids"),
    )
    return _child_rows(parents, "parent_xml")


def unpack_lookup(lookup: DataFrame) -> DataFrame:
    """Packed fragments parsed to fields; fragments that are not well-formed are dropped."""
    parsed = F.filter(F.transform(split_fields(F.col("parent_xml")), parse_field), lambda f: f.isNotNull())
    return lookup.withColumn("fields", parsed).drop("parent_xml")


def explode_nodes(lookup: DataFrame) -> DataFrame:
    """One row per fragment, with the parsed field or null where it is not well-formed."""
    pieces = lookup.select("*", F.posexplode(split_fields(F.col("parent_xml"))).alias("node_pos", "node"))
    return pieces.withColumn("field", parse_field(F.col("node")))


def first_match(lookup: DataFrame) -> DataFrame:
    """The first lookup row of each child. Tasks keep one row per child before the shuffle."""
    others = [name for name in lookup.columns if name not in ("child_id", "ord")]
    first = lookup.groupBy("child_id").agg(F.min_by(F.struct(*others), "ord").alias("first"))
    return first.select("child_id", "first.*")


def enrich_with_parents(records: DataFrame, lookup: DataFrame) -> DataFrame:
    """Append the first parent's fields to every record in the lookup; others pass unchanged.

    Left join on the numeric id with one lookup row per child, so no record is multiplied. These rows
    are written first. So their size is known, and Catalyst broadcasts them only below the session's
    threshold. And above it both sides of the sort-merge join come straight from a shuffle, without
    which the adaptive skew rule would not split a record id that holds many records. A record without
    a numeric id has no match.
    """
    first = first_match(lookup).select(F.col("child_id").alias("_child"), F.col("fields").alias("_fields"))
    parents = stored(first, "parents")
    joined = records.join(parents, records["record_id"].try_cast("long") == parents["_child"], "left")
    kept = [records[name] for name in records.columns if name != "datafield"]
    return joined.select(*kept, append_fields(records["datafield"], F.col("_fields")).alias("datafield"))


def lookup_shape(lookup: DataFrame) -> DataFrame:
    """Rows, distinct children, and children with more than one parent."""
    children = lookup.groupBy("child_id").agg(
        F.count("*").alias("rows"), F.min("parent_id").alias("low"), F.max("parent_id").alias("high")
    )
    return children.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.count("*").alias("children"),
        F.count_if(F.col("low") != F.col("high")).alias("shared_children"),
    )
