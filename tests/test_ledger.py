import pytest
from pyspark.sql import functions as F

from bindery.operators import ledger as L
from bindery.operators.checks import ExpectationError, enforce, expect_no_failures
from bindery.plans.jobs import ledger_prune

LEDGER = "ledger string, pos long, value string"
ITEMS = "ledger string, pos long, name string, ok boolean, failure string"


def rows(spark, *values):
    return spark.createDataFrame([("x", i, v) for i, v in enumerate(values, 1)], LEDGER)


def listed(frame):
    return [r["value"] for r in frame.orderBy("ledger", "pos").collect()]


@pytest.mark.parametrize("held, pushed, unique, skip_blank, result", [
    ([], ["1", "2", "3", "1"], False, True, ["1", "2", "3", "1"]),
    ([], ["1", "2", "3", "1"], True, True, ["1", "2", "3"]),
    ([], [None, ""], True, True, []),
    ([], [None], True, False, [None]),
    ([], ["None"], True, True, ["None"]),
    (["1", "1"], ["1", "2"], True, True, ["1", "1", "2"]),
    ([None], [None, "a"], True, False, [None, "a"]),
])
def test_push(spark, held, pushed, unique, skip_blank, result):
    assert listed(L.push(rows(spark, *held), rows(spark, *pushed), unique, skip_blank)) == result


def items(spark, *values):
    return spark.createDataFrame([("x", i, *v) for i, v in enumerate(values, 1)], ITEMS)


def shown(frame):
    return [(r["name"], r["status"], r["reason"]) for r in frame.orderBy("pos").collect()]


def test_last_is_kept(spark):
    out = L.prune_status(items(spark, ("foo", True, None), ("bar", True, None)))
    assert shown(out) == [("foo", "OK", None), ("bar", "SKIPPED", "skip_from_last")]


def test_precedence(spark):
    given = items(spark, ("foo1", True, None), ("foo", True, None), ("xfoo", False, "500:x"), ("bar", True, None))
    out = L.prune_status(given, 1, ["bar", "foo1"], "foo")
    assert shown(out) == [
        ("foo1", "SKIPPED", "skip_included"), ("foo", "SKIPPED", "skip_matching"), ("xfoo", "FAILED", "500:x"), ("bar", "SKIPPED", "skip_from_last"),
    ]
    assert shown(L.prune_status(given, 0, given.select("name").limit(0))) == [
        ("foo1", "OK", None), ("foo", "OK", None), ("xfoo", "FAILED", "500:x"), ("bar", "OK", None)
    ]
    assert [r[1] for r in shown(L.prune_status(given, 9))] == ["SKIPPED"] * 4


def test_many_kept(spark):
    """More rows kept than the group limit takes."""
    many = spark.range(1, 5001).select(
        F.when(F.col("id") % 3 == 0, "a").otherwise("hot").alias("ledger"), F.col("id").alias("pos"),
        F.col("id").cast("string").alias("name"), F.lit(True).alias("ok"), F.lit(None).cast("string").alias("failure"),
    )
    out = L.prune_status(many, 1500).filter(F.col("status") == "SKIPPED").groupBy("ledger").agg(F.count("*").alias("n"), F.min("pos").alias("m"))
    assert {r["ledger"]: (r["n"], r["m"]) for r in out.collect()} == {"a": (1500, 501), "hot": (1500, 2752)}


def test_blank_in_skip_list(spark):
    with pytest.raises(ValueError):
        L.prune_status(items(spark, ("a", True, None)), 1, ["a", "None"])


def test_stored_ledgers(spark):
    state = spark.createDataFrame([("x", '["a", "b", "a"]'), ("y", ""), ("z", "None")], "key string, value string")
    assert [tuple(r) for r in L.read_ledgers(state).collect()] == [("x", 1, "a"), ("x", 2, "b"), ("x", 3, "a")]


def test_alternatives_are_anchored_together(spark):
    out = spark.range(1).select(L.matches_start(F.lit("xb"), "a|b").alias("m")).first()
    assert out["m"] is False


def test_remaining(spark):
    done = spark.createDataFrame(
        [("x", 1, "buzz", "OK", None), ("x", 2, "foo", "SKIPPED", "s"), ("x", 3, "bar", "SKIPPED", "s"), ("x", 4, "bizz", "FAILED", "500"),
         ("x", 5, "gone", "FAILED", "Could not find collection : gone")],
        "ledger string, pos long, name string, status string, reason string",
    )
    assert listed(L.remaining(done)) == ["bizz", "foo", "bar"]
    assert listed(L.remaining(done, ignore=None)) == ["bizz", "gone", "foo", "bar"]
    with pytest.raises(ExpectationError):
        enforce(expect_no_failures(done))


def test_prune_job(spark):
    outcomes = spark.createDataFrame([("b", False, "500:x"), ("a", True, None)], "name string, ok boolean, failure string")
    left = ledger_prune(rows(spark, "a", "b", "c"), rows(spark, "d", "a"), outcomes, keep_last=2)
    assert listed(left) == ["b", "c", "d"]


def test_unattempted_items_stay(spark):
    outcomes = spark.createDataFrame([("b", True, None)], "name string, ok boolean, failure string")
    left = ledger_prune(rows(spark, "a", "b", "c"), rows(spark), outcomes, keep_last=1)
    assert listed(left) == ["a", "c"]


def test_null_ledger_keeps_its_last_item(spark):
    given = spark.createDataFrame([(None, 1, "x", True, None), (None, 2, "y", True, None)], "ledger string, pos long, name string, ok boolean, failure string")
    assert {r.name: r.reason for r in L.prune_status(given, 1).collect()} == {"x": None, "y": "skip_from_last"}


def test_unreadable_lists_and_blank_names_raise(spark):
    for value in ("['x', 'y'", "plain", "[1, None]", "('x','y')"):
        with pytest.raises(Exception, match="not a list"):
            L.read_ledgers(spark.createDataFrame([("k", value)], "key string, value string")).collect()
    given = spark.createDataFrame([("l", 1, "x", True, None)], "ledger string, pos long, name string, ok boolean, failure string")
    for name in ("", None):
        with pytest.raises(Exception, match="blank name"):
            L.prune_status(given, 1, spark.createDataFrame([(name,)], "name string")).collect()


def test_cut_is_the_same_for_any_number_of_rows(spark):
    rows = spark.createDataFrame([("a", p) for p in range(1, 8)] + [("b", 3), (None, 5), (None, 6)], "ledger string, pos long")
    for keep, cuts in ((1, {"a": 7, "b": 3, None: 6}), (3, {"a": 5, "b": 3, None: 5}), (5000, {"a": 1, "b": 3, None: 5})):
        assert {r["ledger"]: r["_cut"] for r in L.last_cut(rows, keep).collect()} == cuts
