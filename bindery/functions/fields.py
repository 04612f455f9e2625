"""Building and selecting tagged fields and their subfields."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from bindery.schemas import DATAFIELDS, SUBFIELDS

# Default subfield codes, the number of the local parent-link field, the child-id form.
ALL_CODES = "abcdefghijklmnopqrstuvwxyz"
LINK_TAG = "ADF"
CHILD_ID = "^99[0-9]*3811$"
# White space removed around a child id.
ID_SPACE = " \t\r\n\x0b\x0c"


def subfield(code: str, value: Column | str) -> Column:
    value = F.lit(value) if isinstance(value, str) else value
    return F.struct(F.lit(code).alias("code"), value.alias("value"))


def make_datafield(tag: Column | str, subfields: Column, ind1: Column | str = " ", ind2: Column | str = " ") -> Column:
    """One field struct."""
    lit = lambda value: F.lit(value) if isinstance(value, str) else value
    return F.struct(
        lit(tag).alias("tag"), lit(ind1).alias("ind1"), lit(ind2).alias("ind2"), subfields.alias("subfield")
    )


def fields_with_tag(datafield: Column, tag: str) -> Column:
    return F.filter(datafield, lambda field: field["tag"] == F.lit(tag))


def subfield_values(datafield: Column, tag: str, code: str) -> Column:
    """Values of one subfield code over all fields with one tag, in record order."""
    nested = F.transform(
        fields_with_tag(datafield, tag),
        lambda field: F.transform(
            F.filter(F.coalesce(field["subfield"], F.array().cast(SUBFIELDS)), lambda part: part["code"] == F.lit(code)),
            lambda part: part["value"],
        ),
    )
    return F.flatten(nested)


def subfield_select(subfields: Column, codes: str = ALL_CODES, delimiter: str = " ") -> Column:
    """Join the values whose code occurs in ``codes``. A missing value counts as empty text."""
    chosen = F.filter(subfields, lambda part: F.contains(F.lit(codes), F.coalesce(part["code"], F.lit(""))))
    return F.array_join(F.transform(chosen, lambda part: F.coalesce(part["value"], F.lit(""))), delimiter)


def record_id(controlfield: Column) -> Column:
    """Control field 001; null when absent."""
    found = F.filter(controlfield, lambda field: field["tag"] == F.lit("001"))
    return F.get(F.transform(found, lambda field: field["value"]), F.lit(0))


def trimmed_id(text: Column) -> Column:
    return F.trim(text, F.lit(ID_SPACE))


def valid_child_id(text: Column) -> Column:
    """Whether the trimmed text has the bare child-id form."""
    return trimmed_id(text).rlike(CHILD_ID)


def parent_fields(parent_id: Column, datafield: Column) -> Column:
    """What a child inherits: the last item field, every holding field, and a link to the parent."""
    items = fields_with_tag(datafield, "ITM")
    last_item = F.slice(items, F.greatest(F.size(items), F.lit(1)), F.lit(1))
    link = make_datafield(LINK_TAG, F.array(subfield("a", parent_id)))
    return F.concat(last_item, fields_with_tag(datafield, "HLD"), F.array(link))


def append_fields(datafield: Column, extra: Column) -> Column:
    """``datafield`` with ``extra`` behind it; unchanged when ``extra`` is null."""
    return F.when(extra.isNull(), datafield).otherwise(
        F.concat(F.coalesce(datafield, F.array().cast(DATAFIELDS)), extra)
    )
