from datetime import datetime

import pytest
from pyspark.sql import functions as F

from bindery.functions import encode, fields, keys as K, names, punctuation as P, text as X, values as V
from bindery.plans.thesis import title_field


def one(spark, column, **literals):
    frame = spark.range(1).select(*[F.lit(v).alias(k) for k, v in literals.items()]) if literals else spark.range(1)
    return frame.select(column.alias("out")).first()["out"]


def show(parts):
    return [(p["code"], p["value"]) for p in parts]


@pytest.mark.parametrize(
    "name, role, orcid, expected",
    [
        ("Abdel-Salam, Sami", "author", None, [("a", "Abdel-Salam, Sami"), ("e", "author. ")]),
        ("Hiller, Matthew L.", "advisor", None, [("a", "Hiller, Matthew L.,"), ("e", "advisor. ")]),
        (
            "Brightman, Samuel C. (Samuel Charles), 1911-1992", "author", "0000-1",
            [("a", "Brightman, Samuel C. "), ("q", "(Samuel Charles)"), ("d", "1911-1992. "), ("e", "author. "), ("0", "(orcid)0000-1")],
        ),
        ("Doe, Jane, 1911-1992", "author", "http://o/1", [("a", "Doe, Jane"), ("d", "1911-1992. "), ("e", "author. "), ("0", "http://o/1")]),
        ("Bourke-White, Margaret, 1904-1971", "author", None, [("a", "Bourke-White, Margaret"), ("d", "1904-1971. "), ("e", "author. ")]),
        ("Doe, Jane, 1911-", "author", None, [("a", "Doe, Jane"), ("d", "1911-. "), ("e", "author. ")]),
        ("A-b-c", "author", None, [("a", "A-"), ("e", "author. ")]),
        ("12-3", "author", None, [("a", ""), ("d", "12-3. "), ("e", "author. ")]),
        ("-x", "author", None, [("a", "-x"), ("e", "author. ")]),
        ("x (y", "author", None, [("a", "x "), ("q", "()"), ("e", "author. ")]),
        ("", "author", None, [("a", ","), ("e", "author. ")]),
    ],
)
def test_person(spark, name, role, orcid, expected):
    column = names.person_subfields(F.col("n"), F.lit(role), F.lit(orcid).cast("string"))
    assert show(one(spark, column, n=name)) == expected


def by_rule(name):
    """The splitting rules stated step by step on one name."""
    sub = lambda s, start, length=None: "".join(
        c for i, c in enumerate(s, 1) if i >= start and (length is None or i < start + length)
    )
    before = lambda s, d: s.split(d, 1)[0] if d in s else ""
    after = lambda s, d: s.split(d, 1)[1] if d in s else ""
    digit = lambda c: len(c) == 1 and c in "0123456789"
    head, rest = before(name, "-"), after(name, "-")
    second = before(rest, "-")
    if "(" in name:
        a = before(name, "(")
    elif "-" not in name:
        a = name + ","
    elif digit(sub(head, len(head), 1)):
        a = sub(head, 1, len(head) - 6)
    elif "-" in rest:
        a = head + "-" + sub(second, 1, len(second) - 6)
    else:
        a = name
    d = None
    if "-" in name:
        found = sub(rest, len(second) - 3) if "-" in rest else sub(name, len(head) - 3)
        d = found + ". " if digit(sub(found, 1, 1)) else None
    q = "(" + before(after(name, "("), ")") + ")" if "(" in name else None
    return a, q, d


def test_person_against_the_rules(spark):
    import itertools
    import random

    random.seed(1)
    cases = ["".join(c) for n in range(5) for c in itertools.product("a1-(", repeat=n)]
    cases += ["".join(random.choice("ab,.1234 ()--é\n") for _ in range(random.randint(4, 30))) for _ in range(3000)]
    rows = spark.createDataFrame([(c,) for c in cases], "n string").select(
        "n", names.name_part(F.col("n")).alias("a"), names.fuller_form(F.col("n")).alias("q"), names.dates_part(F.col("n")).alias("d")
    ).collect()
    assert {r["n"]: (r["a"], r["q"], r["d"]) for r in rows} == {c: by_rule(c) for c in cases}


@pytest.mark.parametrize(
    "text, expected",
    [
        ("a , b  c, ", ["a ", "b c", ""]), ("plain  text ", ["plain  text "]), ("a,b , ,c", ["a", "b ", "", "c"]),
        (",", ["", ""]), ("", [""]), ("a,\tb\n c", ["a", "b c"]),
    ],
)
def test_keywords(spark, text, expected):
    assert one(spark, X.split_keywords(F.col("t")), t=text) == expected


def test_substrings(spark):
    t = F.col("t")
    made = {
        "b": X.substring_before(t, ":"), "none": X.substring_before(t, "#"), "a": X.substring_after(t, ":"),
        "gone": X.substring_after(t, "#"), "clip": X.xp_substring(t, -1, 4), "neg": X.xp_substring(t, 2, -3), "tail": X.xp_substring(t, 0),
        "n": X.normalize_space(F.lit(" a \n\t b ")), "s": X.repeat_char(F.lit(3), "x"), "z": X.repeat_char(F.lit(-1)),
    }
    row = spark.range(1).select(F.lit("ab:c:d").alias("t")).select(*[c.alias(k) for k, c in made.items()]).first().asDict()
    assert row == {"b": "ab", "none": "", "a": "c:d", "gone": "", "clip": "ab", "neg": "", "tail": "ab:c:d", "n": "a b", "s": "xxx", "z": ""}


def test_punctuation(spark):
    t = F.lit("[.: Title]. /")
    assert one(spark, P.chop_trailing(t)) == "[.: Title]"
    assert one(spark, P.chop_leading(t)) == "Title]. /"
    assert one(spark, P.chop_trailing_close(t)) == "[.: Title"
    assert one(spark, P.chop_trailing(F.lit(" .,"))) == ""


def test_url_encode(spark):
    """All characters up to the end of the basic plane, and some above it."""
    kept = set("!'()*-.0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ_abcdefghijklmnopqrstuvwxyz~")
    code = lambda c: c if c in kept else f"%{ord(c):02X}" if 32 <= ord(c) < 127 or 161 <= ord(c) < 256 else "%3F"
    chars = [chr(n) for n in range(1, 0x10000) if not 0xD800 <= n < 0xE000] + ["\U0001F600", "\U0010FFFF"]
    texts = ["".join(chars[i : i + 50]) for i in range(0, len(chars), 50)]
    latin = [chr(n) for n in range(32, 256)]
    texts += [a + "".join(b + a for b in latin) for a in latin]
    rows = spark.createDataFrame(list(enumerate(texts)), "i long, t string").select("i", encode.url_encode_latin1(F.col("t")).alias("e"))
    assert {r["i"]: r["e"] for r in rows.collect()} == {i: "".join(map(code, t)) for i, t in enumerate(texts)}


@pytest.mark.parametrize("title, ind2, parts", [
    ("The Art: A Study", "4", [("a", "The Art : "), ("b", " A Study /"), ("c", "by Jane Doe.")]),
    ("An Art", "3", [("a", "An Art /"), ("c", "by Jane Doe.")]),
    ("the art", "0", [("a", "the art /"), ("c", "by Jane Doe.")]),
])
def test_title(spark, title, ind2, parts):
    row = one(spark, title_field(F.lit(title), F.lit("Doe, Jane")))
    assert row["ind2"] == ind2 and show(row["subfield"]) == parts


def test_keys(spark):
    false, true = F.lit(False), F.lit(True)
    assert one(spark, K.batch_stamp(F.lit("alma_bibs__2020050503_18470272620003811_new_1.xml"), false)) == 2020050503
    assert one(spark, K.batch_stamp(F.lit("alma_bibs__boundwith2_2022031420_2739_new.xml.tar.gz"), true)) == 2022031420
    key = F.lit("almasftp/alma_bibs__new_1.xml.tar.gz")
    assert one(spark, K.dest_key(key, "almasftp/alma_bibs__", ".tar.gz", "almasftp/test/2019")) == "almasftp/test/2019/alma_bibs__new_1.xml"
    assert one(spark, K.parse_datestamp(K.key_datestamp(F.lit("alma_bibs__2019-07-01T00:00:00z_1")))) == datetime(2019, 7, 1)
    assert one(spark, K.key_datestamp(F.lit("other"))) is None
    assert one(spark, K.overlap_from(F.lit(2020060800))) == "2020-06-07T00:00:00Z"
    assert one(spark, K.processed_key(F.lit("a/new-updated/new-updated/deleted"))) == "a/processed-new-updated/new-updated/processed-deleted"
    assert one(spark, K.needs_relocation(F.lit("a/b"))) is False
    assert one(spark, K.flat_name(F.lit("a/b/c"), "out/")) == "out/a-b-c.xml"
    assert one(spark, K.clean_item_id(F.lit("http://dx.doi.org/10.34944/dspace/602"))) == "10_34944_dspace_602"
    assert one(spark, K.snapshot_name(F.lit("None"), F.lit("catalog"), F.lit("2020"), F.lit("7"))) == "catalog.7-2020"
    assert one(spark, K.map_language(F.lit("es"))) == "spa"


def test_values(spark):
    assert one(spark, V.parse_list(F.lit(None).cast("string"))) == []
    assert one(spark, V.parse_list(F.lit("None"))) == []
    assert one(spark, V.parse_list(F.lit("['a', 'b']"))) == ["a", "b"]
    assert one(spark, V.parse_list(F.lit('["a"]'))) == ["a"]
    assert one(spark, V.parse_list(F.lit("no list"))) is None
    assert one(spark, V.num_found(F.lit('{"response":{"numFound":12}}'))) == 12
    assert one(spark, V.num_found(F.lit("<html>"))) == 0
    assert one(spark, V.failure_reason(F.lit('{"error":{"msg":"m"}}'), F.lit(400), F.lit("Bad"))) == "m"
    assert one(spark, V.failure_reason(F.lit("{}"), F.lit(500), F.lit("Bad"))) == "500:Bad"


def test_subfield_select(spark):
    made = F.array(*[F.struct(F.lit(c).alias("code"), F.lit(v).alias("value")) for c, v in (("a", "x"), ("9", "y"), ("b", "z"))])
    assert one(spark, fields.subfield_select(made)) == "x z"
    assert one(spark, fields.subfield_select(made, "q")) == ""
