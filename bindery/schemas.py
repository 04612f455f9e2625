"""Record types shared by sources, operators and plans."""

from __future__ import annotations

SUBFIELDS = "array<struct<code:string,value:string>>"
DATAFIELD = f"struct<tag:string,ind1:string,ind2:string,subfield:{SUBFIELDS}>"
DATAFIELDS = f"array<{DATAFIELD}>"
CONTROLFIELDS = "array<struct<tag:string,value:string>>"

# How the XML source names attributes and text: attribute prefix "_", text "_VALUE".
XML_MARC = (
    "_type string, `_airflow-record-id` string, leader string, "
    "controlfield array<struct<_tag:string,_VALUE:string>>, "
    "datafield array<struct<_tag:string,_ind1:string,_ind2:string,"
    "subfield:array<struct<_code:string,_VALUE:string>>>>"
)
XML_DATAFIELD = (
    "_tag string, _ind1 string, _ind2 string, subfield array<struct<_code:string,_VALUE:string>>"
)
XML_OAI_MARC = (
    "header struct<_status:string,identifier:string,datestamp:string,setSpec:array<string>>, "
    "metadata struct<record:struct<"
    "leader:string,controlfield:array<struct<_tag:string,_VALUE:string>>,"
    "datafield:array<struct<_tag:string,_ind1:string,_ind2:string,"
    "subfield:array<struct<_code:string,_VALUE:string>>>>>>"
)

XOAI_FIELDS = "array<struct<_VALUE:string,_name:string>>"


def xoai_elements(levels: int = 4) -> str:
    """The nested ``element`` array: named elements holding named fields, ``levels`` deep, what is deeper as text."""
    inner = f"field:{XOAI_FIELDS},element:" + (xoai_elements(levels - 1) if levels > 1 else "array<string>")
    return f"array<struct<_name:string,{inner}>>"



def xml_xoai(levels: int = 4) -> str:
    return (
        "header struct<_status:string,identifier:string,datestamp:string,setSpec:array<string>>, "
        f"metadata struct<metadata:struct<element:{xoai_elements(levels)}>,element:{xoai_elements(levels)}>"
    )


LOOKUP_CSV = "child_id long, parent_id long, parent_xml string"
INVENTORY = "key string, mtime timestamp, size long"
LEDGER = "ledger string, pos long, value string"
STATE = "key string, value string, version long"

# Keep text as it stands: no trimming, and no text read as null.
KEEP_TEXT = {
    "attributePrefix": "_",
    "valueTag": "_VALUE",
    "ignoreSurroundingSpaces": "false",
    "ignoreNamespace": "true",
    "nullValue": "\u0000",
}
