"""Thesis records made from documents, mapped to bibliographic records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from bindery.plans.thesis import long_form, xoai_to_marc
from bindery.schemas import xoai_elements
from workload.registry import query, table


def _element(level: int, name: str, children: list[Column] | Column | None = None, fields: list[tuple[str, Column]] = ()) -> Column:
    made = F.array(*[F.struct(value.alias("_VALUE"), F.lit(code).alias("_name")) for code, value in fields])
    parts = [F.lit(name).alias("_name"), made.cast("array<struct<_VALUE:string,_name:string>>").alias("field")]
    if level == 1:
        parts.append(F.array().cast("array<string>").alias("element"))
    else:
        inner = children if isinstance(children, Column) else F.array(*(children or []))
        parts.append(inner.cast(xoai_elements(level - 1)).alias("element"))
    return F.struct(*parts)


def _leaf(level: int, values: list[Column] | Column) -> Column:
    """The wildcard element that wraps values."""
    if isinstance(values, list):
        values = F.array(*values)
    made = F.transform(values, lambda v: F.struct(v.alias("_VALUE"), F.lit("value").alias("_name")))
    parts = [F.lit("none").alias("_name"), made.alias("field")]
    parts.append(F.array().cast(xoai_elements(level - 1) if level > 1 else "array<string>").alias("element"))
    return F.struct(*parts)


def _plain(name: str, values) -> Column:
    return _element(3, name, [_leaf(2, values)])


def _qualified(name: str, **parts) -> Column:
    return _element(3, name, [_element(2, part, [_leaf(1, values)]) for part, values in parts.items()])


def document_theses(spark, sf_dir) -> DataFrame:
    """Repository records: the lines of a document are its subjects, the rest is made from its columns."""
    doc, kind = F.col("doc_id").cast("string"), F.col("lang")
    english = kind == "en"
    creators = F.when(english, F.array(F.concat(F.lit("Abdel-Salam, "), "source"), F.lit(""), F.concat("source", F.lit(" (Sam), 1911-1992"))))
    creators = creators.when(kind == "fr", F.array(F.lit(""), F.col("source"))).otherwise(F.array(F.concat("source", F.lit(", Jane"))))
    some = lambda condition, *items: F.when(condition, F.array(*items)).otherwise(F.array())
    handle = _element(2, "uri", [_leaf(1, [F.concat(F.lit("http://hdl.handle.net/"), doc)])])
    files = [
        _element(2, "filename", [_leaf(1, [F.concat("source", F.lit("_thesis.pdf"))])]),
        _element(2, "proqst", [_leaf(1, [F.concat(F.lit("p"), doc)])]),
    ]
    dc = _element(4, "dc", F.array(
        _element(3, "contributor", [
            _element(2, "advisor", [_leaf(1, [F.lit("Hiller, Matthew L.")])]),
            _element(2, "committeemember", [_leaf(1, [F.lit("Welsh, Wayne N."), F.concat(F.lit("Belenko, "), "source", F.lit(", 1950-"))])]),
        ]),
        _element(3, "creator", [_leaf(2, creators), _element(2, "orcid", [_leaf(1, some(english, F.concat(F.lit("0000-"), doc)))])]),
        _qualified("date", issued=[F.lit("2011-05")]),
        _element(3, "identifier", F.when(kind == "es", F.array(handle, *files)).otherwise(F.array(handle))),
        _element(3, "description", [
            _leaf(2, [F.concat(F.lit(" note  of "), "source")]),
            _element(2, "abstract", [_leaf(1, [F.col("text")])]),
            _element(2, "department", [_leaf(1, [F.concat(F.lit("Department "), "source")])]),
            _element(2, "degree", [_leaf(1, [F.lit("Ph.D.")])]),
        ]),
        _qualified("format", extent=[F.concat(F.col("n_chars").cast("string"), F.lit(" pages"))]),
        _qualified("language", iso=some(kind != "de", F.when(english, "eng").otherwise(kind))),
        _qualified("relation", doi=some(english, F.concat(F.lit("http://dx.doi.org/10.34944/dspace/"), doc))),
        _element(3, "rights", [_leaf(2, [F.lit("IN COPYRIGHT")]), _element(2, "uri", [_leaf(1, [F.lit("http://rights.example.org/")])])]),
        _plain("subject", F.split("text", "\n")),
        _plain("title", [F.concat(F.lit("The "), "source", F.when(english, ": A Study").otherwise(""))]),
        _qualified("embargo", lift=some(kind == "es", F.lit("2030-01-01"))),
    ))
    bundles = _element(4, "bundles", [_element(3, "bundle", [_element(2, "bitstreams", [
        _element(1, "bitstream", fields=[("description", F.when(kind == "fr", "Supplemental File").otherwise("Extracted text"))])
    ])])])
    return table(spark, sf_dir, "documents").select("doc_id", F.array(dc, bundles).cast(xoai_elements()).alias("element"))


def _rule(number: int, tag: str, parts: str, ind1: str = "' '", ind2: str = "' '", item: str = "0", source: str = "d", where: str = "true") -> str:
    """One mapping rule as SQL: ``parts`` is a list of {code, value} structs."""
    return (
        f"SELECT doc_id, {number} AS rule, {item} AS item, {tag} AS tag, {ind1} AS ind1, {ind2} AS ind2, {parts} AS parts "
        f"FROM {source} WHERE {where}"
    )


def _parts(**values: str) -> str:
    return "[" + ", ".join(f"{{'code': '{code.strip('_')}', 'value': {value}}}" for code, value in values.items()) + "]"


def _name(name: str, role: str, a: str, q: str | None = None, d: str | None = None, orcid: str | None = None) -> str:
    values = {"a": a} | ({"q": q} if q else {}) | ({"d": d} if d else {}) | {"e": f"'{role}. '"} | ({"_0": orcid} if orcid else {})
    return _parts(**values)


ORCID = "'(orcid)0000-' || doc_id"
RULES = [
    _rule(1, "'024'", _parts(a="source || '_thesis'"), "'8'", where="lang = 'es'"),
    _rule(2, "'035'", _parts(a="'(MiAaPQD)p' || doc_id"), where="lang = 'es'"),
    _rule(3, "'035'", _parts(a="'(PPT)' || CASE WHEN lang = 'en' THEN '10_34944_dspace_' || doc_id ELSE '' END")),
    _rule(4, "'040'", _parts(a="'TEU'", b="'eng'", c="'TEU'", e="'rda'")),
    _rule(5, "'100'", _name("", "author", "'Abdel-Salam, ' || source", orcid=ORCID), "'1'", where="lang = 'en'"),
    _rule(6, "'700'", _name("", "author", "source || ' '", "'(Sam)'", "'1911-1992. '", ORCID), "'1'", where="lang = 'en'"),
    _rule(5, "'700'", _name("", "author", "source || ','"), "'1'", where="lang = 'fr'"),
    _rule(5, "'100'", _name("", "author", "source || ', Jane,'"), "'1'", where="lang NOT IN ('en', 'fr')"),
    _rule(7, "'245'", _parts(a="'The ' || source || ' : '", b="' A Study' || ' /'", c="'by ' || source || ' Abdel-Salam.'"), "'1'", "'4'", where="lang = 'en'"),
    _rule(7, "'245'", _parts(a="'The ' || source || ' /'", c="CASE lang WHEN 'fr' THEN 'by.' ELSE 'by Jane ' || source || '.' END"), "'1'", "'4'", where="lang <> 'en'"),
    _rule(8, "'264'", _parts(a="'[Philadelphia, Pennsylvania] :'", b="'Temple University Libraries, '", c="'2011. '"), ind2="'1'"),
    _rule(9, "'300'", _parts(a="'1 online resource (' || n_chars || ' pages).'")),
    _rule(10, "'336'", _parts(a="'text'", _2="'rdacontent'")),
    _rule(11, "'337'", _parts(a="'computer'", _2="'rdamedia'")),
    _rule(12, "'338'", _parts(a="'online resource'", _2="'rdacarrier'")),
    _rule(13, "'500'", _parts(a="'note of ' || source")),
    _rule(14, "'502'", _parts(b="'Ph.D.'", c="'Temple University'", d="'2011-05'")),
    _rule(15, "'500'", _parts(a="'Department: Department ' || source || '.'")),
    _rule(16, "'520'", _parts(a=r"trim(regexp_replace(text, '[ \t\r\n]+', ' ', 'g'))")),
    _rule(17, "'504'", _parts(a="'Includes bibliographical references.'")),
    _rule(18, "'506'", _parts(a="'Free-to-read'", f="'Unrestricted online access'", _2="'star'", _5="'PPT'"), "'0'"),
    _rule(19, "'540'", _parts(a="'IN COPYRIGHT'", u="'http://rights.example.org/'")),
    _rule(20, "'653'", _parts(a="token"), item="line_pos * 1000000 + token_pos", source="tokens"),
    _rule(21, "'690'", _parts(a="'Department ' || source", x="'Temple University theses.'"), ind2="'4'"),
    _rule(22, "'690'", _parts(a="'Temple University'", x="'Theses.'"), ind2="'4'"),
    _rule(23, "'655'", _parts(a="'Academic theses.'", _2="'lcgft'"), ind2="'7'"),
    _rule(24, "'700'", _name("", "advisor", "'Hiller, Matthew L.,'"), "'1'"),
    _rule(25, "'700'", _name("", "committee member", "'Welsh, Wayne N.,'"), "'1'"),
    _rule(26, "'700'", _name("", "committee member", "'Belenko, ' || source", d="'1950-. '"), "'1'"),
    _rule(27, "'973'", _parts(t="'Temple University Theses and Dissertations'"), "'0'", "'8'"),
    _rule(28, "'856'", _parts(u="CASE WHEN lang = 'en' THEN 'http://dx.doi.org/10.34944/dspace/' || doc_id ELSE 'http://hdl.handle.net/' || doc_id END", z="'Access online resource.'"), "'4'", "'0'"),
    _rule(29, "'902'", _parts(a="'Language check: ''' || CASE lang WHEN 'es' THEN 'spa' WHEN 'de' THEN 'und' ELSE lang END || ''''"), where="lang <> 'en'"),
    _rule(30, "'902'", _parts(a="'EMBARGO LIFT: 2030-01-01'"), where="lang = 'es'"),
    _rule(31, "'902'", _parts(a="'Includes Supplemental File'"), where="lang = 'fr'"),
]
TOKENS = r"""
d AS (SELECT doc_id, text, lang, source, n_chars FROM documents),
ls AS (SELECT doc_id, unnest(range(len(l))) AS line_pos, unnest(l) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM d)),
tokens AS (
  SELECT doc_id, line_pos, 0 AS token_pos, CASE WHEN instr(line, ',') > 0 THEN substr(line, 1, instr(line, ',') - 1) ELSE line END AS token FROM ls
  UNION ALL
  SELECT doc_id, line_pos, unnest(range(len(p))) + 1, ltrim(unnest(p)) FROM (
    SELECT doc_id, line_pos, string_split(trim(regexp_replace(substr(line, instr(line, ',') + 1), '[ \t\r\n]+', ' ', 'g')), ',') AS p
    FROM ls WHERE instr(line, ',') > 0))
"""
MAPPED = f"""
WITH {TOKENS}, rules AS ({' UNION ALL '.join(RULES)}),
placed AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY rule, item) - 1 AS field_pos FROM rules)
SELECT doc_id, field_pos, tag, ind1, ind2, part_pos, p.code AS code, p.value AS value
FROM (SELECT doc_id, field_pos, tag, ind1, ind2, unnest(range(len(parts))) AS part_pos, unnest(parts) AS p FROM placed)
"""


def mapped(spark, sf_dir) -> DataFrame:
    return xoai_to_marc(document_theses(spark, sf_dir), F.lit("2024-02-01").cast("date"), ["doc_id"])


@query("xoai_to_marc", MAPPED)
def thesis_fields(spark, sf_dir):
    """Every subfield of every mapped record, in order."""
    rows = long_form(mapped(spark, sf_dir), ["doc_id"])
    return rows.withColumns({name: F.col(name).cast("long") for name in ("field_pos", "part_pos")})


@query("xoai_controlfields", """
SELECT doc_id, '00000nam#a22000007i#4500' AS leader, 'm#####o##d########' AS c006, 'cr#unu||||||||' AS c007,
       '240201s2011####pau#####obm###000#0#' || CASE lang WHEN 'en' THEN 'eng' WHEN 'es' THEN 'spa' WHEN 'de' THEN 'und' ELSE lang END || '#d' AS c008
FROM documents
""")
def thesis_controlfields(spark, sf_dir):
    value = lambda i: F.col("controlfield")[i]["value"]
    return mapped(spark, sf_dir).select("doc_id", "leader", value(0).alias("c006"), value(1).alias("c007"), value(2).alias("c008"))
