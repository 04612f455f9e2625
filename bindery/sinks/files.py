"""Lookup files, record files and change folders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from bindery.functions.keys import HARVEST_FORMAT
from bindery.functions.packed_xml import NAMESPACE
from bindery.session import stored
from bindery.sources.drops import CSV_QUOTING

# Records per output file.
RECORDS_PER_FILE = 1000
BOUNDWITH_RECORDS_PER_FILE = 10000
# Text in a lookup file, more or less.
LOOKUP_FILE_BYTES = 32 << 20


def write_lookup(lookup: DataFrame, path: str, file_bytes: int = LOOKUP_FILE_BYTES) -> None:
    """Child lookup as CSV, in lookup order, on which the first match rests.

    The header is written even without rows. Rows are sorted over all tasks, one file each. The lookup is stored first, so
    that it is computed once and not again for the sort's sample. Files are read whole, so there is one for about every
    ``file_bytes`` of text, however few partitions a shuffle has.
    """
    kept = stored(lookup.select("ord", "child_id", "parent_id", "parent_xml"), "lookup")
    rows, size = kept.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("parent_xml")), F.lit(0))).first()
    files = size // file_bytes + 1
    placed = kept.repartitionByRange(files, "ord").sortWithinPartitions("ord") if files > 1 else kept.orderBy("ord")
    columns = placed.select("child_id", "parent_id", "parent_xml")
    # A frame without partitions writes no file at all, so keep one for the header.
    if not rows:
        columns = columns.coalesce(1)
    columns.write.options(quoteAll="false", **CSV_QUOTING).csv(path)


def xml_columns(records: DataFrame) -> list[Column]:
    """Record columns in the shape the XML writer needs."""
    control = F.transform("controlfield", lambda f: F.struct(f["tag"].alias("_tag"), f["value"].alias("_VALUE")))
    parts = lambda field: F.transform(
        field["subfield"], lambda s: F.struct(s["code"].alias("_code"), s["value"].alias("_VALUE"))
    )
    data = F.transform(
        "datafield",
        lambda f: F.struct(
            f["tag"].alias("_tag"), f["ind1"].alias("_ind1"), f["ind2"].alias("_ind2"), parts(f).alias("subfield")
        ),
    )
    columns = [F.col("leader"), control.alias("controlfield"), data.alias("datafield")]
    if "airflow_record_id" in records.columns:
        columns.insert(0, F.col("airflow_record_id").alias("_airflow-record-id"))
    if "record_type" in records.columns:
        columns.insert(0, F.col("record_type").alias("_type"))
    return columns


def write_marcxml(
    records: DataFrame, path: str, by: str | None = None, records_per_file: int | None = None
) -> None:
    """Records as collections. With ``by``, a folder per value of that column.

    Rows are rebalanced by that column: small folders get one file, and one with a third of all rows is split over
    tasks when the query runs.
    """
    columns = xml_columns(records)
    if by:
        columns.append(F.col(by))
    rows = records.select(*columns)
    if by:
        rows = rows.hint("rebalance", F.col(by))
    writer = rows.write.format("xml").options(
        rootTag=f'collection xmlns="{NAMESPACE}"', rowTag="record", attributePrefix="_", valueTag="_VALUE"
    )
    if records_per_file:
        writer = writer.option("maxRecordsPerFile", records_per_file)
    if by:
        writer = writer.partitionBy(by)
    writer.save(path)


def write_cleaned(records: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Repository records without name spaces and with a single metadata wrapper."""
    header = F.struct(
        F.when(F.col("deleted"), "deleted").alias("_status"), F.col("oai_id").alias("identifier"),
        F.date_format("datestamp", HARVEST_FORMAT).alias("datestamp"), F.col("sets").alias("setSpec"),
    )
    columns = [F.col("oai_id").alias("_airflow-record-id"), header.alias("header"), F.struct("element").alias("metadata")]
    records.select(*columns).write.format("xml").options(
        rootTag="collection", rowTag="record", attributePrefix="_", valueTag="_VALUE", maxRecordsPerFile=records_per_file
    ).save(path)


def write_chunked(df: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE) -> None:
    """At most ``records_per_file`` rows in each Parquet file."""
    df.write.option("maxRecordsPerFile", records_per_file).parquet(path)


def write_routed(changes: DataFrame, path: str) -> None:
    """Updates and deletes in a folder each, named by the ``change`` column."""
    changes.write.partitionBy("change").parquet(path)
