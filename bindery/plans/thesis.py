"""Repository thesis metadata mapped to bibliographic records.

Every record is mapped on its own, so the mapping is one narrow projection without a shuffle: a first
select reads the metadata values out of the nested elements, a second builds the fields from them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from bindery.functions.fields import make_datafield, subfield
from bindery.functions.keys import clean_item_id, filename_id, map_language
from bindery.functions.names import person_subfields
from bindery.functions.text import normalize_space, short_date, split_keywords, substring_after, substring_before, title_skip
from bindery.schemas import DATAFIELDS

# Fixed values of the output records.
LEADER = "00000nam#a22000007i#4500"
CONTROL_006 = "m#####o##d########"
CONTROL_007 = "cr#unu||||||||"
CONTROL_008_MIDDLE = "####pau#####obm###000#0#"
CONTROL_008_END = "#d"
ADMIN_PREFIX = "(MiAaPQD)"
ITEM_PREFIX = "(PPT)"
PLACE = "[Philadelphia, Pennsylvania] :"
PUBLISHER = "Temple University Libraries, "
INSTITUTION = "Temple University"
THESES_OF = "Temple University theses."
THESES = "Theses."
COLLECTION = "Temple University Theses and Dissertations"
BIBLIOGRAPHY = "Includes bibliographical references."
ACCESS = "Access online resource."
SUPPLEMENT, SUPPLEMENT_NOTE = "Supplemental File", "Includes Supplemental File"
UNDETERMINED, ENGLISH = "und", "eng"
CONTENT_TYPES = [
    ("336", "text", "rdacontent"), ("337", "computer", "rdamedia"), ("338", "online resource", "rdacarrier"),
]


# The paths below are SQL text rather than nested Python lambdas: they are parsed in one call each.
def _named(elements: str, name: str) -> str:
    return f"filter({elements}, e -> e._name = '{name}')"


def _children(elements: str) -> str:
    """All child elements of several elements."""
    return f"flatten(transform({elements}, e -> coalesce(e.element, array())))"


def _under(root: str, *path: str) -> str:
    """Elements at a path of names below the element ``root``."""
    found = _named(f"coalesce({root}.element, array())", path[0])
    for name in path[1:]:
        found = _named(_children(found), name)
    return found


def _texts(elements: str, field: str = "value", first_each: bool = False) -> str:
    """Text of the elements' own fields of one name; with ``first_each`` one of each element."""
    named = f"filter(coalesce(e.field, array()), f -> f._name = '{field}')"
    if first_each:
        named = f"slice({named}, 1, 1)"
    return f"flatten(transform({elements}, e -> transform({named}, f -> coalesce(f._VALUE, ''))))"


def _values(path: tuple[str, ...], first_each: bool = False) -> str:
    """Values one wildcard element below a path of the ``dc`` element."""
    return _texts(_children(_under("dc", *path)), first_each=first_each)


def _first(values: Column) -> Column:
    """First value; empty when there is none."""
    return F.coalesce(F.get(values, F.lit(0)), F.lit(""))


def _joined(values: Column) -> Column:
    """All values as text, with a space between."""
    return F.array_join(values, " ")


# Metadata read from each record: column name -> path.
SOURCES = {
    "issued": ("date", "issued"), "language": ("language", "iso"), "creators": ("creator",),
    "embargo": ("embargo", "lift"), "handle": ("identifier", "uri"), "doi": ("relation", "doi"),
    "filename": ("identifier", "filename"), "admin_id": ("identifier", "proqst"), "extent": ("format", "extent"),
    "notes": ("description",), "degree": ("description", "degree"), "department": ("description", "department"),
    "rights": ("rights",), "rights_uri": ("rights", "uri"), "subjects": ("subject",),
    "advisors": ("contributor", "advisor"), "committee": ("contributor", "committeemember"),
}
FIRST_OF_EACH = {"titles": ("title",), "orcid": ("creator", "orcid"), "abstracts": ("description", "abstract")}
# Printed with all their values.
PRINTED = ["issued", "embargo", "handle", "doi", "admin_id", "extent", "degree", "department", "rights", "rights_uri"]
TESTED = {"filename": ("identifier", "filename"), "admin_id": ("identifier", "proqst"), "department": ("description", "department")}


def read_metadata(records: DataFrame, keep: list[str]) -> DataFrame:
    """One row per ``dc`` element with the values the mapping needs. ``records`` has ``element``."""
    each = records.select(*keep, "element", F.explode(F.expr(_named("element", "dc"))).alias("dc"))
    columns = [F.expr(_values(path)).alias(name) for name, path in SOURCES.items()]
    columns += [F.expr(_values(path, first_each=True)).alias(name) for name, path in FIRST_OF_EACH.items()]
    columns += [F.expr(f"size({_under('dc', *path)}) > 0").alias(f"has_{name}") for name, path in TESTED.items()]
    files = _named("element", "bundles")
    for name in ("bundle", "bitstreams", "bitstream"):
        files = _named(_children(files), name)
    columns.append(F.array_contains(F.expr(_texts(files, "description")), SUPPLEMENT).alias("supplement"))
    return each.select(*keep, *columns)


def _text(value: str) -> str:
    """A constant as SQL text."""
    return "'" + value.replace("'", "\\'") + "'"


def _field(tag: str, *parts: tuple[str, str], ind1: str = " ", ind2: str = " ", when: str | None = None) -> Column:
    """One field as an array, empty unless ``when`` holds. ``parts`` are codes and SQL expressions."""
    made = ", ".join(f"named_struct('code', '{code}', 'value', {value})" for code, value in parts)
    field = f"array(named_struct('tag', '{tag}', 'ind1', '{ind1}', 'ind2', '{ind2}', 'subfield', array({made})))"
    return F.expr(f"if({when}, {field}, array())" if when else field)


def _each(values: Column, build) -> Column:
    return F.transform(values, build)


def _people(values: Column, role: str, orcid: Column | None = None) -> Column:
    return _each(values, lambda name: make_datafield("700", person_subfields(name, F.lit(role), orcid), "1"))


def author_fields(creators: Column, orcid: Column | None = None) -> Column:
    """Main entry for the first creator, added entries for the rest.

    The place counts empty names too: with an empty first name there is no main entry.
    """
    numbered = F.transform(creators, lambda name, i: F.struct(name.alias("name"), i.alias("place")))
    filled = F.filter(numbered, lambda a: a["name"] != "")
    return _each(
        filled,
        lambda a: make_datafield(
            F.when(a["place"] == 0, "100").otherwise("700"), person_subfields(a["name"], F.lit("author"), orcid), "1"
        ),
    )


def responsibility(author: Column) -> Column:
    """Statement of responsibility: given name first when the name has a comma."""
    inverted = F.concat(F.lit("by"), substring_after(author, ","), F.lit(" "), substring_before(author, ","), F.lit("."))
    return F.when(F.contains(author, F.lit(",")), inverted).otherwise(F.concat(F.lit("by"), author, F.lit(".")))


def title_field(title: Column, author: Column) -> Column:
    """Title entry, cut at the first colon if there is one."""
    by = subfield("c", responsibility(author))
    two = F.array(
        subfield("a", F.concat(substring_before(title, ":"), F.lit(" : "))),
        subfield("b", F.concat(substring_after(title, ":"), F.lit(" /"))), by,
    )
    one = F.array(subfield("a", F.concat(title, F.lit(" /"))), by)
    parts = F.when(F.contains(title, F.lit(":")), two).otherwise(one)
    return make_datafield("245", parts, "1", title_skip(title).cast("string"))


def build_records(metadata: DataFrame, keep: list[str], run_date: Column) -> DataFrame:
    """Leader, control fields and data fields, in output order."""
    c = F.col
    language = F.when(normalize_space(_first(c("language"))) == "", UNDETERMINED).otherwise(map_language(_first(c("language"))))
    metadata = metadata.withColumns(
        {
            "year": F.substr(_first(c("issued")), F.lit(1), F.lit(4)), "thesis_language": language, "run_day": short_date(run_date),
            "file_id": filename_id(_first(c("filename"))), "item_id": clean_item_id(_first(c("doi"))),
            **{name: _joined(c(name)) for name in PRINTED}, "has_doi": F.size("doi") > 0, "has_embargo": F.size("embargo") > 0,
        }
    )
    orcid = F.get(c("orcid"), F.lit(0))
    day_etc = F.expr(f"concat(run_day, 's', year, {_text(CONTROL_008_MIDDLE)}, thesis_language, {_text(CONTROL_008_END)})")
    control = F.array(
        *[
            F.struct(F.lit(tag).alias("tag"), value.alias("value"))
            for tag, value in (("006", F.lit(CONTROL_006)), ("007", F.lit(CONTROL_007)), ("008", day_etc))
        ]
    )
    note = lambda tag: lambda text: make_datafield(tag, F.array(subfield("a", normalize_space(text))))
    fields = [
        _field("024", ("a", "file_id"), ind1="8", when="has_filename"),
        _field("035", ("a", f"concat({_text(ADMIN_PREFIX)}, admin_id)"), when="has_admin_id"),
        _field("035", ("a", f"concat({_text(ITEM_PREFIX)}, item_id)")),
        _field("040", ("a", "'TEU'"), ("b", "'eng'"), ("c", "'TEU'"), ("e", "'rda'")),
        author_fields(c("creators"), orcid),
        F.array(title_field(_first(c("titles")), _first(c("creators")))),
        _field("264", ("a", _text(PLACE)), ("b", _text(PUBLISHER)), ("c", "concat(year, '. ')"), ind2="1"),
        _field("300", ("a", "concat('1 online resource (', extent, ').')")),
        *[_field(tag, ("a", _text(kind)), ("2", _text(source))) for tag, kind, source in CONTENT_TYPES],
        _each(c("notes"), note("500")),
        _field("502", ("b", "degree"), ("c", _text(INSTITUTION)), ("d", "issued")),
        _field("500", ("a", "concat('Department: ', department, '.')"), when="has_department"),
        _each(c("abstracts"), note("520")),
        _field("504", ("a", _text(BIBLIOGRAPHY))),
        _field("506", ("a", "'Free-to-read'"), ("f", "'Unrestricted online access'"), ("2", "'star'"), ("5", "'PPT'"), ind1="0"),
        _field("540", ("a", "rights"), ("u", "rights_uri")),
        _each(
            F.flatten(F.transform(c("subjects"), split_keywords)),
            lambda word: make_datafield("653", F.array(subfield("a", word))),
        ),
        _field("690", ("a", "department"), ("x", _text(THESES_OF)), ind2="4", when="has_department"),
        _field("690", ("a", _text(INSTITUTION)), ("x", _text(THESES)), ind2="4"),
        _field("655", ("a", "'Academic theses.'"), ("2", "'lcgft'"), ind2="7"),
        _people(c("advisors"), "advisor"),
        _people(c("committee"), "committee member"),
        _field("973", ("t", _text(COLLECTION)), ind1="0", ind2="8"),
        _field("856", ("u", "if(has_doi, doi, handle)"), ("z", _text(ACCESS)), ind1="4", ind2="0"),
        _field("902", ("a", "concat('Language check: \\'', thesis_language, '\\'')"), when=f"thesis_language <> {_text(ENGLISH)}"),
        _field("902", ("a", "concat('EMBARGO LIFT: ', embargo)"), when="has_embargo"),
        _field("902", ("a", _text(SUPPLEMENT_NOTE)), when="supplement"),
    ]
    return metadata.select(
        *keep, F.lit(LEADER).alias("leader"), control.alias("controlfield"), F.concat(*fields).alias("datafield")
    )


def xoai_to_marc(records: DataFrame, run_date: Column, keep: list[str] | None = None) -> DataFrame:
    """Map repository records. ``run_date`` is a parameter, so that a rerun gives equal records."""
    keep = keep or [name for name in records.columns if name != "element"]
    return build_records(read_metadata(records, keep), keep, run_date)


def long_form(records: DataFrame, keep: list[str]) -> DataFrame:
    """One row per subfield of the data fields. One generator for both levels keeps the plan small."""
    rows = F.transform(
        "datafield",
        lambda f, i: F.transform(
            f["subfield"],
            lambda s, j: F.struct(
                i.alias("field_pos"), f["tag"].alias("tag"), f["ind1"].alias("ind1"), f["ind2"].alias("ind2"),
                j.alias("part_pos"), s["code"].alias("code"), s["value"].alias("value"),
            ),
        ),
    )
    return records.select(*keep, F.inline(F.flatten(rows)))
