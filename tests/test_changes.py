import random

import pytest
from pyspark.sql import functions as F

from bindery.operators import changes as C, state as T
from bindery.operators.checks import ExpectationError, enforce, expect_different, expect_not_blank
from bindery.operators.snapshots import missing_snapshots, publish_snapshot, read_snapshot, snapshot_path
from bindery.streaming.apply import apply_stream, compact, merged, stream_harvest

CHANGE = "id long, stamp long, v string, change string"


@pytest.mark.parametrize("updated, deleted, branch", [
    (834, 2, "updates_and_deletes_branch"), (834, 0, "updates_only_branch"), (0, 2, "deletes_only_branch"),
    (0, 0, "no_updates_no_deletes_branch"), (None, 2, "deletes_only_branch"), (None, None, "no_updates_no_deletes_branch"),
])
def test_branch(spark, updated, deleted, branch):
    counts = spark.createDataFrame([(updated, deleted)], "updated long, deleted long")
    assert C.classify_batch(counts).first()["branch"] == branch


def snapshot(spark):
    return spark.createDataFrame([(1, 0, "one"), (2, 0, "two"), (3, 0, "three")], "id long, stamp long, v string")


def as_set(frame):
    return {tuple(r) for r in frame.select("id", "stamp", "v").collect()}


BATCH = [
    (1, 5, "newer", C.UPDATED), (1, 4, "older", C.UPDATED),  # latest wins
    (2, 9, "both", C.UPDATED), (2, 1, None, C.DELETED),  # deleted although updated later
    (4, 1, "added", C.UPDATED), (99, 1, None, C.DELETED),  # unknown id
]


def test_apply(spark):
    batch = spark.createDataFrame(BATCH, CHANGE)
    once = C.apply_changes(snapshot(spark), batch, "id", ["stamp", "v"], ["stamp"])
    assert as_set(once) == {(1, 5, "newer"), (3, 0, "three"), (4, 1, "added")}
    assert as_set(C.apply_changes(once, batch, "id", ["stamp", "v"], ["stamp"])) == as_set(once)
    assert as_set(C.delete_keys(snapshot(spark), batch.filter(F.col("change") == C.DELETED), "id")) == {(1, 0, "one"), (3, 0, "three")}


def test_window_is_closed_and_open(spark):
    rows = spark.createDataFrame([(n, [s]) for n, s in ((1, "a"), (2, "b"), (3, "a"))], "datestamp long, sets array<string>")
    pick = lambda **k: [r["datestamp"] for r in C.harvest_window(rows, **k).orderBy("datestamp").collect()]
    assert pick(since=F.lit(2), until=F.lit(3)) == [2, 3]
    assert pick() == [1, 2, 3] and pick(sets=["a"]) == [1, 3] and pick(until=F.lit(1)) == [1]
    assert C.harvest(rows, F.lit(2), transform=lambda df: df.limit(1)).count() == 1


def test_stream_equals_batches(spark, tmp_path):
    """Several micro-batches, one of them written again after a failure, then compaction."""
    random.seed(5)
    batches, state = [], {i: (0, "base") for i in range(40)}
    for n in range(4):
        rows = [(random.randrange(60), n * 100 + i, f"v{n}-{i}", random.choice([C.UPDATED, C.UPDATED, C.DELETED])) for i in range(50)]
        batches.append(rows)
        for i, stamp, v, change in rows:
            if change == C.UPDATED:
                state[i] = (stamp, v)
        for i, *_, change in rows:
            if change == C.DELETED:
                state.pop(i, None)
    inbox, root = tmp_path / "inbox", str(tmp_path / "root")
    base = spark.range(40).select("id", F.lit(0).cast("long").alias("stamp"), F.lit("base").alias("v"))
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, CHANGE).coalesce(1).write.mode("append").json(str(inbox))
        stream = stream_harvest(spark, str(inbox), CHANGE, "json", files_per_trigger=1)
        apply_stream(stream, root, "id", ["stamp", "v"], ["stamp"]).awaitTermination()
    want = {(i, *row) for i, row in state.items()}
    assert as_set(merged(base, root, "id")) == want
    again = C.net_changes(spark.createDataFrame(batches[3], CHANGE), "id", ["stamp", "v"], ["stamp"])
    again.write.mode("overwrite").parquet(f"{root}/changes/epoch=3")
    assert as_set(merged(base, root, "id")) == want
    assert as_set(compact(base, root, "id", str(tmp_path / "compacted"))) == want


def test_no_batch_yet(spark, tmp_path):
    (tmp_path / "inbox").mkdir()
    stream = stream_harvest(spark, str(tmp_path / "inbox"), CHANGE, "json")
    apply_stream(stream, str(tmp_path / "root"), "id", ["stamp", "v"], ["stamp"]).awaitTermination()
    assert as_set(merged(snapshot(spark), str(tmp_path / "root"), "id")) == as_set(snapshot(spark))


def test_consumed_files_are_archived(spark, tmp_path):
    inbox, archive, root = tmp_path / "in" / "box", tmp_path / "archive", str(tmp_path / "root")
    for n in range(3):
        spark.createDataFrame([BATCH[0]], CHANGE).coalesce(1).write.mode("append").json(str(inbox))
        stream = stream_harvest(spark, str(inbox), CHANGE, "json", archive=str(archive))
        apply_stream(stream, root, "id", ["stamp", "v"], ["stamp"]).awaitTermination()
    # A file is moved when the batch behind it is planned, so the last one may still be in place.
    assert list(archive.rglob("*.json"))


def test_state(spark):
    schema = "key string, value string, version long"
    old = spark.createDataFrame([("a", "1", 1), ("b", "", 1)], schema)
    new = T.upsert_state(old, spark.createDataFrame([("a", "2", 2), ("a", "3", 3), ("c", "None", 2)], schema))
    assert {r["key"]: r["value"] for r in new.collect()} == {"a": "3", "b": "", "c": "None"}
    wanted = spark.createDataFrame([(k,) for k in "abcd"], "key string")
    assert {r["key"]: r["value"] for r in T.read_state(new, "x", wanted).collect()} == {"a": "3", "b": "x", "c": "x", "d": "x"}


def test_bounds_advance_only_with_changes(spark):
    runs = spark.createDataFrame(
        [("p", "f1", None, "now", 1, 0), ("q", "f2", "u2", "now", 0, 0)],
        "target string, harvest_from string, harvest_until string, logical_time string, updated long, deleted long",
    )
    old = spark.createDataFrame([("p_FROM", "f1", 1), ("q_FROM", "f2", 1)], "key string, value string, version long")
    new = T.advance_bounds(old, runs, runs, F.lit(2).cast("long"))
    assert {r["key"]: r["value"] for r in new.collect()} == {"p_FROM": "now", "p_LAST_FROM": "f1", "q_FROM": "f2"}


def test_publish(spark, tmp_path):
    root = str(tmp_path)
    publish_snapshot(spark.range(3), root, "c-1", "live", 1)
    publish_snapshot(spark.range(9), root, "c-1", "live", 2)  # there already: not written again
    assert read_snapshot(spark, root, "live").count() == 3
    (tmp_path / "snapshot=c-2").mkdir()  # left behind by a lost job
    publish_snapshot(spark.range(5), root, "c-2", "live", 3)
    assert read_snapshot(spark, root, "live").count() == 5
    assert spark.read.parquet(snapshot_path(root, "c-1")).count() == 3
    name = lambda *n: spark.createDataFrame([(x,) for x in n], "name string")
    assert [r["name"] for r in missing_snapshots(name("a", "b"), name("b", "b")).collect()] == ["a"]


def test_expectations(spark):
    rows = spark.createDataFrame([("x", "a", "a"), ("y", None, None), ("z", "a", "b")], "s string, l string, r string")
    assert [v["subject"] for v in expect_different(rows, "l", "r", "s").collect()] == ["x"]
    blank = expect_not_blank(rows, "l", "s")
    assert [v["subject"] for v in blank.collect()] == ["y"]
    with pytest.raises(ExpectationError, match="not_blank: y"):
        enforce(blank)
    enforce(blank.limit(0))
