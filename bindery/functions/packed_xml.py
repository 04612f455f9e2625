"""Field lists packed into one string: XML fragments joined by a double bar."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from bindery.functions.fields import LINK_TAG
from bindery.schemas import KEEP_TEXT, SUBFIELDS, XML_DATAFIELD

# The separator, the name space and the two element spellings.
SEPARATOR = "||"
NAMESPACE = "http://www.loc.gov/MARC21/slim"


def _escaped(text: Column, attribute: bool = False) -> Column:
    out = F.coalesce(text, F.lit(""))
    pairs = [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")]
    if attribute:
        pairs.append(('"', "&quot;"))
    for plain, entity in pairs:
        out = F.replace(out, F.lit(plain), F.lit(entity))
    return out


def _subfields_xml(subfields: Column, prefix: str) -> Column:
    one = lambda part: F.concat(
        F.lit(f'<{prefix}subfield code="'), _escaped(part["code"], True), F.lit('">'),
        _escaped(part["value"]), F.lit(f"</{prefix}subfield>"),
    )
    return F.array_join(F.transform(F.coalesce(subfields, F.array().cast(SUBFIELDS)), one), "")


def datafield_xml(field: Column) -> Column:
    """One field as an XML fragment; the parent link has its own spelling."""
    tag, ind1, ind2 = (_escaped(field[name], True) for name in ("tag", "ind1", "ind2"))
    plain = F.concat(
        F.lit(f'<datafield xmlns="{NAMESPACE}" tag="'), tag, F.lit('" ind1="'), ind1, F.lit('" ind2="'), ind2,
        F.lit('">'), _subfields_xml(field["subfield"], ""), F.lit("</datafield>"),
    )
    link = F.concat(
        F.lit(f'<marc21:datafield xmlns:marc21="{NAMESPACE}" ind1="'), ind1, F.lit('" ind2="'), ind2,
        F.lit('" tag="'), tag, F.lit('">'), _subfields_xml(field["subfield"], "marc21:"), F.lit("</marc21:datafield>"),
    )
    return F.when(field["tag"] == F.lit(LINK_TAG), link).otherwise(plain)


def pack_fields(fields: Column) -> Column:
    """Pack a field array for the lookup file."""
    return F.array_join(F.transform(fields, datafield_xml), SEPARATOR)


def split_fields(packed: Column) -> Column:
    """The fragments of a packed string."""
    return F.split(packed, "\\|\\|")


def parse_field(fragment: Column) -> Column:
    """A fragment as a field struct; null when it is not well-formed."""
    raw = F.from_xml(fragment, XML_DATAFIELD, {**KEEP_TEXT, "mode": "PERMISSIVE"})
    subfields = F.transform(
        F.coalesce(raw["subfield"], F.array().cast("array<struct<_code:string,_VALUE:string>>")),
        lambda part: F.struct(part["_code"].alias("code"), F.coalesce(part["_VALUE"], F.lit("")).alias("value")),
    )
    made = F.struct(
        raw["_tag"].alias("tag"), raw["_ind1"].alias("ind1"), raw["_ind2"].alias("ind2"), subfields.alias("subfield")
    )
    return F.when(raw["_tag"].isNotNull(), made)
