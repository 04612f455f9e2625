"""Bibliographic, harvested and repository records from XML files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from bindery.functions.fields import record_id
from bindery.schemas import (
    CONTROLFIELDS, DATAFIELDS, KEEP_TEXT, XML_MARC, XML_OAI_MARC, xml_xoai, xoai_elements,
)


REJECTED = "rejected"


def _read(spark: SparkSession, path: str | list[str], schema: str, mode: str) -> DataFrame:
    """Raw records. A file that is not well-formed fails the job, or in PERMISSIVE mode gives a row with its text."""
    reader = spark.read.format("xml").schema(f"{schema}, {REJECTED} string").options(
        rowTag="record", mode=mode, columnNameOfCorruptRecord=REJECTED, **KEEP_TEXT
    )
    return reader.load(path).withColumns(
        # Files are read whole and in order, so the row id grows with the position in a file.
        {"src_key": F.input_file_name(), "rec_pos": F.monotonically_increasing_id()}
    )


def _position(mode: str) -> list[str]:
    return ["src_key", "rec_pos", REJECTED] if mode == "PERMISSIVE" else ["src_key", "rec_pos"]


def controlfields(raw: Column) -> Column:
    made = F.transform(
        raw, lambda f: F.struct(f["_tag"].alias("tag"), F.coalesce(f["_VALUE"], F.lit("")).alias("value"))
    )
    return F.coalesce(made, F.array().cast(CONTROLFIELDS))


def datafields(raw: Column) -> Column:
    parts = lambda field: F.transform(
        F.coalesce(field["subfield"], F.array().cast("array<struct<_code:string,_VALUE:string>>")),
        lambda s: F.struct(s["_code"].alias("code"), F.coalesce(s["_VALUE"], F.lit("")).alias("value")),
    )
    made = F.transform(
        raw,
        lambda f: F.struct(
            f["_tag"].alias("tag"), f["_ind1"].alias("ind1"), f["_ind2"].alias("ind2"), parts(f).alias("subfield")
        ),
    )
    return F.coalesce(made, F.array().cast(DATAFIELDS))


def marc_columns(leader: Column, control: Column, data: Column) -> list[Column]:
    """Raw XML columns as a record: id, leader, control fields, data fields."""
    control = controlfields(control)
    return [
        record_id(control).alias("record_id"), leader.alias("leader"),
        control.alias("controlfield"), datafields(data).alias("datafield"),
    ]


def read_marcxml(spark: SparkSession, path: str | list[str], mode: str = "FAILFAST") -> DataFrame:
    """Records of a collection, with or without the name space.

    In PERMISSIVE mode unreadable records stay as rows with their text in ``rejected``. The attributes of a record are
    ``record_type`` and ``airflow_record_id``.
    """
    raw = _read(spark, path, XML_MARC, mode)
    return raw.select(
        *_position(mode), *marc_columns(F.col("leader"), F.col("controlfield"), F.col("datafield")),
        F.col("_type").alias("record_type"), F.col("`_airflow-record-id`").alias("airflow_record_id"),
    )


def _header(mode: str) -> list[Column]:
    """Header columns. A date stamp may be a day or a second; another form is null in PERMISSIVE mode, else an error."""
    text = F.col("header.datestamp")
    stamp = text.try_cast("timestamp_ntz")
    if mode != "PERMISSIVE":
        unread = F.raise_error(F.concat(F.lit("not a date stamp: "), text)).cast("timestamp_ntz")
        stamp = F.when(text.isNotNull() & stamp.isNull(), unread).otherwise(stamp)
    return [
        F.col("header.identifier").alias("oai_id"),
        stamp.alias("datestamp"),
        F.coalesce(F.col("header.setSpec"), F.array().cast("array<string>")).alias("sets"),
        (F.coalesce(F.col("header._status"), F.lit("")) == "deleted").alias("deleted"),
    ]


def read_oai_marcxml(spark: SparkSession, path: str | list[str], mode: str = "FAILFAST") -> DataFrame:
    """Bibliographic records inside harvest records. Deleted ones have no fields."""
    raw = _read(spark, path, XML_OAI_MARC, mode)
    inner = F.col("metadata.record")
    return raw.select(
        *_position(mode), *_header(mode),
        *marc_columns(inner["leader"], inner["controlfield"], inner["datafield"]),
    )


def _deepest(elements: Column, levels: int) -> Column:
    """What lies below the last level that has a type, as text."""
    for _ in range(levels):
        below = F.transform(elements, lambda e: e["element"])
        elements = F.flatten(F.filter(below, lambda e: e.isNotNull()))
    return elements


def read_xoai(spark: SparkSession, path: str | list[str], mode: str = "FAILFAST", levels: int = 4) -> DataFrame:
    """Repository records. Name spaces go at the scan; a doubled metadata wrapper is taken off.

    Elements nested deeper than ``levels`` are an error; in PERMISSIVE mode they are kept as text in the last level. The
    mapping reads four levels. A copy of deeper records needs more.
    """
    raw = _read(spark, path, xml_xoai(levels), mode)
    none = F.array().cast(xoai_elements(levels))
    element = F.coalesce(F.col("metadata.metadata.element"), F.col("metadata.element"), none)
    if mode != "PERMISSIVE":
        deep = F.raise_error(F.lit(f"elements nested deeper than {levels} levels")).cast(xoai_elements(levels))
        element = F.when(F.size(_deepest(element, levels)) > 0, deep).otherwise(element)
    return raw.select(*_position(mode), *_header(mode), element.alias("element"))
