"""String functions over whole texts, urls and names."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindery.functions import encode, fields, keys as K, names, punctuation, text as X
from bindery.plans.thesis import author_fields, title_field
from workload.registry import query, table

COLLAPSED = r"trim(regexp_replace({0}, '[ \t\r\n]+', ' ', 'g'))"


@query("keyword_split", rf"""
WITH cut AS (SELECT doc_id, text, instr(text, ',') AS p FROM documents),
later AS (
  SELECT doc_id, unnest(range(len(parts))) + 1 AS token_pos, ltrim(unnest(parts)) AS token FROM (
    SELECT doc_id, string_split({COLLAPSED.format("substr(text, p + 1)")}, ',') AS parts FROM cut WHERE p > 0))
SELECT doc_id, CAST(0 AS BIGINT) AS token_pos, CASE WHEN p > 0 THEN substr(text, 1, p - 1) ELSE text END AS token FROM cut
UNION ALL SELECT doc_id, CAST(token_pos AS BIGINT), token FROM later
""")
def keyword_split(spark, sf_dir):
    tokens = F.posexplode(X.split_keywords(F.col("text"))).alias("token_pos", "token")
    return table(spark, sf_dir, "documents").select("doc_id", tokens).select(
        "doc_id", F.col("token_pos").cast("long").alias("token_pos"), "token"
    )


@query("normalize_space", f"SELECT doc_id, {COLLAPSED.format('text')} AS text FROM documents")
def normalize_space(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.normalize_space(F.col("text")).alias("text"))


@query("substring_functions", """
SELECT doc_id,
       CASE WHEN instr(text, '. ') > 0 THEN substr(text, 1, instr(text, '. ') - 1) ELSE '' END AS before,
       CASE WHEN instr(text, '. ') > 0 THEN substr(text, instr(text, '. ') + 2) ELSE '' END AS after,
       substr(text, 1, CAST(greatest(n_chars - 103, 0) AS BIGINT)) AS clipped,
       CASE WHEN n_chars - 20 < 1 THEN text ELSE substr(text, n_chars - 20) END AS tail,
       regexp_matches(text, '^[0-9]') AS digit,
       translate(text, 'aeiou', 'AEIOU') AS swapped,
       repeat('#', length(text)) AS spaces
FROM (SELECT doc_id, text, CAST(length(text) AS BIGINT) AS n_chars FROM documents)
""")
def substring_functions(spark, sf_dir):
    text, size = F.col("text"), F.length("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id", X.substring_before(text, ". ").alias("before"), X.substring_after(text, ". ").alias("after"),
        X.xp_substring(text, -2, size - F.lit(100)).alias("clipped"),
        X.xp_substring(text, size - F.lit(20)).alias("tail"), X.is_digit_at(text, 1).alias("digit"),
        X.translate(text, "aeiou", "AEIOU").alias("swapped"), X.repeat_char(size, "#").alias("spaces"),
    )


@query("chop_punctuation", """
SELECT doc_id, rtrim(text, '.:,;/ ') AS back, ltrim(text, '.:,;/[ ') AS front, rtrim(text, '.:,;/] ') AS close FROM documents
""")
def chop_punctuation(spark, sf_dir):
    text = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id", punctuation.chop_trailing(text).alias("back"), punctuation.chop_leading(text).alias("front"),
        punctuation.chop_trailing_close(text).alias("close"),
    )


ENCODED = r"""array_to_string(list_transform(string_split({0}, ''), lambda c:
    CASE WHEN c = '' THEN '' WHEN instr('!''()*-.0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ_abcdefghijklmnopqrstuvwxyz~', c) > 0 THEN c
         WHEN unicode(c) BETWEEN 32 AND 126 OR unicode(c) BETWEEN 161 AND 255 THEN '%' || printf('%02X', unicode(c))
         ELSE '%3F' END), '')"""


@query("url_encode_latin1", f"SELECT doc_id, {ENCODED.format('text')} AS encoded FROM documents")
def url_encode_latin1(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", encode.url_encode_latin1(F.col("text")).alias("encoded"))


@query("url_encode_pages", f"SELECT page_id, {ENCODED.format('url')} AS url, {ENCODED.format('html')} AS html FROM pages")
def url_encode_pages(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", encode.url_encode_latin1(F.col("url")).alias("url"), encode.url_encode_latin1(F.col("html")).alias("html")
    )


@query("subfield_select", """
SELECT doc_id, array_to_string(list_filter(lines, lambda l: contains('aeiou', lower(left(l, 1)))), ' ') AS vowels,
       array_to_string(list_filter(lines, lambda l: contains('abcdefghijklmnopqrstuvwxyz', lower(left(l, 1)))), '--') AS letters
FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents)
""")
def subfield_select(spark, sf_dir):
    parts = F.transform(
        F.split("text", "\n"), lambda line: F.struct(F.lower(F.substring(line, 1, 1)).alias("code"), line.alias("value"))
    )
    return table(spark, sf_dir, "documents").select(
        "doc_id", fields.subfield_select(parts, "aeiou").alias("vowels"),
        fields.subfield_select(parts, delimiter="--").alias("letters"),
    )


@query("item_id", r"""
SELECT page_id, regexp_replace(CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END,
                               '[^a-zA-Z0-9\-:_]', '_', 'g') AS item_id,
       CASE WHEN instr(url, '.html') > 0 THEN substr(url, 1, instr(url, '.html') - 1) ELSE '' END AS file_id
FROM pages
""")
def item_id(spark, sf_dir):
    url = F.col("url")
    doi = F.replace(url, F.lit("://"), F.lit("://doi.org/"))
    pdf = F.replace(url, F.lit(".html"), F.lit(".pdf"))
    return table(spark, sf_dir, "pages").select(
        "page_id", K.clean_item_id(doi).alias("item_id"), K.filename_id(pdf).alias("file_id")
    )


@query("language_map", "SELECT doc_id, CASE lang WHEN 'es' THEN 'spa' ELSE lang END AS language FROM documents")
def language_map(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", K.map_language(F.col("lang")).alias("language"))


@query("short_date", "SELECT o_orderkey, strftime(o_orderdate, '%y%m%d') AS day FROM orders")
def short_date(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", X.short_date(F.col("o_orderdate")).alias("day"))


TITLE = """CASE p_type WHEN 'ECONOMY' THEN 'The ' || p_name || ': a ' || p_brand WHEN 'SMALL' THEN 'A ' || p_name
           WHEN 'STANDARD' THEN 'An ' || p_name || ':' ELSE p_name || ' of: ' || p_brand || ': ' || p_type END"""


@query("title_field", f"""
WITH titled AS (SELECT p_partkey, {TITLE} AS t, CASE WHEN p_size > 25 THEN p_brand || ', ' || p_name ELSE p_brand END AS a FROM part)
SELECT p_partkey, CASE WHEN starts_with(t, 'The ') THEN '4' WHEN starts_with(t, 'An ') THEN '3' WHEN starts_with(t, 'A ') THEN '2' ELSE '0' END AS ind2,
       CASE WHEN instr(t, ':') > 0 THEN 'a=' || substr(t, 1, instr(t, ':') - 1) || ' : |b=' || substr(t, instr(t, ':') + 1) || ' /'
            ELSE 'a=' || t || ' /' END || '|c=by'
       || CASE WHEN instr(a, ',') > 0 THEN substr(a, instr(a, ',') + 1) || ' ' || substr(a, 1, instr(a, ',') - 1) ELSE a END || '.' AS parts
FROM titled
""")
def title_fields(spark, sf_dir):
    kind, name, brand = F.col("p_type"), F.col("p_name"), F.col("p_brand")
    title = (
        F.when(kind == "ECONOMY", F.concat(F.lit("The "), name, F.lit(": a "), brand))
        .when(kind == "SMALL", F.concat(F.lit("A "), name))
        .when(kind == "STANDARD", F.concat(F.lit("An "), name, F.lit(":")))
        .otherwise(F.concat(name, F.lit(" of: "), brand, F.lit(": "), kind))
    )
    author = F.when(F.col("p_size") > 25, F.concat(brand, F.lit(", "), name)).otherwise(brand)
    made = table(spark, sf_dir, "part").select("p_partkey", title_field(title, author).alias("f"))
    parts = F.transform("f.subfield", lambda s: F.concat(s["code"], F.lit("="), s["value"]))
    return made.select("p_partkey", F.col("f.ind2").alias("ind2"), F.array_join(parts, "|").alias("parts"))


# Names in every form the splitting distinguishes, made from customers.
PERSON = """CASE c_mktsegment
  WHEN 'BUILDING' THEN c_name || ' (' || c_mktsegment || ' K.), ' || (1900 + c_nationkey) || '-' || (1950 + c_nationkey)
  WHEN 'MACHINERY' THEN 'Bourke-White, ' || c_name || ', ' || (1900 + c_nationkey) || '-1971'
  WHEN 'FURNITURE' THEN c_name || ', ' || (1900 + c_nationkey) || '-'
  WHEN 'HOUSEHOLD' THEN 'Abdel-Salam, ' || CASE WHEN c_acctbal < 0 THEN '' ELSE c_mktsegment END
  ELSE c_mktsegment || ', Matthew L.' END"""


def person_name():
    year = lambda base: (F.lit(base) + F.col("c_nationkey")).cast("string")
    name, kind = F.col("c_name"), F.col("c_mktsegment")
    return (
        F.when(kind == "BUILDING", F.concat(name, F.lit(" ("), kind, F.lit(" K.), "), year(1900), F.lit("-"), year(1950)))
        .when(kind == "MACHINERY", F.concat(F.lit("Bourke-White, "), name, F.lit(", "), year(1900), F.lit("-1971")))
        .when(kind == "FURNITURE", F.concat(name, F.lit(", "), year(1900), F.lit("-")))
        .when(kind == "HOUSEHOLD", F.concat(F.lit("Abdel-Salam, "), F.when(F.col("c_acctbal") < 0, "").otherwise(kind)))
        .otherwise(F.concat(kind, F.lit(", Matthew L.")))
    )


NAME_CUT = """
cut AS (SELECT *, instr(n, '-') AS p1, CASE WHEN instr(n, '-') > 0 THEN substr(n, instr(n, '-') + 1) ELSE '' END AS rest FROM named),
cut2 AS (SELECT *, CASE WHEN p1 > 0 THEN substr(n, 1, p1 - 1) ELSE '' END AS head, instr(rest, '-') AS p2 FROM cut),
cut3 AS (SELECT *, CASE WHEN p2 > 0 THEN substr(rest, greatest(p2 - 1 - 3, 1)) ELSE substr(n, greatest(p1 - 1 - 3, 1)) END AS d FROM cut2)
"""
NAME_A = """CASE WHEN instr(n, '(') > 0 THEN substr(n, 1, instr(n, '(') - 1)
            WHEN p1 = 0 THEN n || ','
            WHEN regexp_matches(head, '[0-9]$') THEN substr(head, 1, greatest(length(head) - 6, 0))
            WHEN p2 > 0 THEN head || '-' || substr(rest, 1, greatest(p2 - 1 - 6, 0))
            ELSE n END"""


@query("person_fields", f"""
WITH named AS (SELECT c_custkey, {PERSON} AS n, CASE WHEN c_acctbal > 5000 THEN 'https://orcid.org/' || c_custkey WHEN c_acctbal > 0 THEN c_custkey || '' END AS o FROM customer),
{NAME_CUT}
SELECT c_custkey, {NAME_A} AS a,
       CASE WHEN instr(n, '(') > 0 THEN '(' || split_part(substr(n, instr(n, '(') + 1), ')', 1) || ')' ELSE '' END AS q,
       CASE WHEN p1 > 0 AND regexp_matches(d, '^[0-9]') THEN d || '. ' ELSE '' END AS d,
       'author. ' AS e,
       CASE WHEN o IS NULL THEN '' WHEN contains(o, 'http') THEN o ELSE '(orcid)' || o END AS orcid
FROM cut3
""")
def person_fields(spark, sf_dir):
    balance, key = F.col("c_acctbal"), F.col("c_custkey").cast("string")
    orcid = F.when(balance > 5000, F.concat(F.lit("https://orcid.org/"), key)).when(balance > 0, key)
    made = table(spark, sf_dir, "customer").select(
        "c_custkey", names.person_subfields(person_name(), F.lit("author"), orcid).alias("parts")
    )
    part = lambda code: F.coalesce(
        F.get(F.transform(F.filter("parts", lambda s: s["code"] == code), lambda s: s["value"]), F.lit(0)), F.lit("")
    )
    return made.select("c_custkey", *[part(c).alias(n) for c, n in (("a", "a"), ("q", "q"), ("d", "d"), ("e", "e"), ("0", "orcid"))])


@query("person_entries", f"""
WITH named AS (SELECT * FROM (SELECT doc_id, unnest(range(len(l))) AS place, unnest(l) AS n FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)) WHERE n <> ''),
{NAME_CUT}
SELECT doc_id, place, CASE WHEN place = 0 THEN '100' ELSE '700' END AS tag, {NAME_A} AS a FROM cut3
""")
def person_entries(spark, sf_dir):
    """Every line of a document taken as a creator: the first one gets the main entry."""
    lines = F.split("text", "\n")
    rows = table(spark, sf_dir, "documents").select("doc_id", lines.alias("lines"))
    filled = F.filter(F.transform("lines", lambda l, i: F.when(l != "", i)), lambda i: i.isNotNull())
    zipped = F.arrays_zip(filled.alias("place"), author_fields(F.col("lines")).alias("field"))
    made = rows.select("doc_id", F.inline(zipped).alias("place", "field"))
    first = F.filter("field.subfield", lambda s: s["code"] == "a")
    return made.select("doc_id", F.col("place").cast("long").alias("place"), F.col("field.tag").alias("tag"), F.coalesce(F.get(first, F.lit(0))["value"], F.lit("")).alias("a"))
