"""Bucketed snapshots and committed micro-batches: whole or not at all, and only what changed."""

import os
import random

import pytest
from pyspark.sql import functions as F

from bindery.operators import buckets, changes as C, commits
from bindery.operators.checks import ExpectationError
from bindery.operators.files import emptied_dirs, move_conflicts
from bindery.operators.ledger import last_cut
from bindery.operators.snapshots import publish_snapshot, read_snapshot
from bindery.plans.jobs import harvest_into
from bindery.streaming import epochs
from bindery.streaming.apply import stream_harvest

CHANGE = "id long, stamp long, v string, change string"
PAYLOAD, ORDER = ["stamp", "v"], ["stamp"]


def base(spark, n=40):
    return spark.range(n).select("id", F.lit(0).cast("long").alias("stamp"), F.lit("base").alias("v"))


def rows(frame):
    return sorted(tuple(r) for r in frame.select("id", "stamp", "v").collect())


def data_files(root):
    return {os.path.join(d, f) for d, _, names in os.walk(f"{root}/data") for f in names if f.startswith("part-")}


def applied(state, batch):
    for i, stamp, v, change in sorted(batch, key=lambda r: r[1]):
        if change == C.UPDATED:
            state[i] = (stamp, v)
    for i, *_, change in batch:
        if change == C.DELETED:
            state.pop(i, None)
    return state


def make_batch(make, n):
    return [(make.randrange(60), n * 100 + i, f"v{n}-{i}", make.choice([C.UPDATED, C.UPDATED, C.DELETED])) for i in range(30)]


def test_put_if_absent(spark, tmp_path):
    path = f"{tmp_path}/records/1.json"
    commits.put_if_absent(spark, path, "first")
    with pytest.raises(commits.CommitConflict):
        commits.put_if_absent(spark, path, "second")
    assert open(path).read() == "first" and [n for n in os.listdir(f"{tmp_path}/records") if not n.endswith(".crc")] == ["1.json"]


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    root = str(tmp_path)
    buckets.create_snapshot(base(spark), root, "id", 8)
    before = data_files(root)
    net = C.net_changes(spark.createDataFrame([(3, 1, "new", C.UPDATED), (500, 1, None, C.DELETED)], CHANGE), "id", PAYLOAD, ORDER)
    touched = {r[0] for r in spark.createDataFrame([(3,), (500,)], "id long").select(buckets.bucket_of(F.col("id"), 8)).collect()}
    record = buckets.apply_to_buckets(spark, root, net)
    assert before <= data_files(root)
    old, new = (r["places"] for _, r in buckets.history(spark, root))
    assert {int(b) for b in old if old[b] != new[b]} == touched and len(touched) == 2 and record["places"] == new
    assert rows(buckets.read_snapshot(spark, root)) == sorted([(i, 0, "base") for i in range(40) if i != 3] + [(3, 1, "new")])
    assert rows(buckets.read_snapshot(spark, root, 0)) == rows(base(spark)) and buckets.rows_of(record) == 40


def test_emptied_bucket_and_vacuum(spark, tmp_path):
    root = str(tmp_path)
    buckets.create_snapshot(base(spark), root, "id", 4)
    everything = spark.range(40).select("id", F.lit(1).cast("long").alias("stamp"), F.lit(None).cast("string").alias("v"), F.lit(C.DELETED).alias("change"))
    record = buckets.apply_to_buckets(spark, root, C.net_changes(everything, "id", PAYLOAD, ORDER))
    assert record["places"] == {} and buckets.read_snapshot(spark, root).count() == 0
    buckets.apply_to_buckets(spark, root, C.net_changes(spark.createDataFrame([(1, 2, "back", C.UPDATED)], CHANGE), "id", PAYLOAD, ORDER))
    assert len(buckets.vacuum(spark, root)) == 2 and rows(buckets.read_snapshot(spark, root)) == [(1, 2, "back")]
    with pytest.raises(ValueError):
        buckets.create_snapshot(base(spark), f"{root}/other", "id", 0)


def test_two_writers_of_one_version(spark, tmp_path):
    root = str(tmp_path)
    buckets.create_snapshot(base(spark), root, "id", 4)
    start = buckets.current(spark, root)
    records = [buckets.rewritten(spark, root, C.net_changes(spark.createDataFrame([(1, 1, v, C.UPDATED)], CHANGE), "id", PAYLOAD, ORDER), start) for v in "ab"]
    buckets.commit_version(spark, root, 1, records[0])
    with pytest.raises(commits.CommitConflict):
        buckets.commit_version(spark, root, 1, records[1])
    assert (1, 1, "a") in rows(buckets.read_snapshot(spark, root))


@pytest.mark.parametrize("step", [(epochs, "write_observed"), (epochs, "branch_of"), (epochs, "net_changes"), (buckets, "_write"), (buckets, "commit_version")])
def test_batch_that_dies_changes_nothing(spark, tmp_path, monkeypatch, step):
    """The driver dies right after a step, or before the record is written; the batch is then replayed."""
    root, batch = str(tmp_path), make_batch(random.Random(2), 1)
    buckets.create_snapshot(base(spark), root, "id", 4)
    frame = spark.createDataFrame(batch, CHANGE)
    module, name = step
    whole = getattr(module, name)

    def dies(*args, **kwargs):
        if name != "commit_version":
            whole(*args, **kwargs)
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(module, name, dies)
        with pytest.raises(KeyboardInterrupt):
            epochs.commit_batch(frame, root, 0, PAYLOAD, ORDER, "stamp")
    assert rows(buckets.read_snapshot(spark, root)) == rows(base(spark)) and "epoch" not in buckets.current(spark, root)[1]
    record = epochs.commit_batch(frame, root, 0, PAYLOAD, ORDER, "stamp")
    want = sorted((i, *row) for i, row in applied({i: (0, "base") for i in range(40)}, batch).items())
    assert rows(buckets.read_snapshot(spark, root)) == want and record["after"] == len(want) and record["before"] == 40
    # Once more, after the record: nothing is done, and the same record comes back.
    again = epochs.commit_batch(spark.createDataFrame([], CHANGE), root, 0, PAYLOAD, ORDER, "stamp")
    assert again == record and len(buckets.history(spark, root)) == 2


def test_bound_moves_with_changes_only(spark, tmp_path):
    root = str(tmp_path)
    buckets.create_snapshot(base(spark), root, "id", 4)
    first = epochs.commit_batch(spark.createDataFrame([(1, 7, "x", C.UPDATED)], CHANGE), root, 0, PAYLOAD, ORDER, "stamp")
    empty = epochs.commit_batch(spark.createDataFrame([], CHANGE), root, 1, PAYLOAD, ORDER, "stamp")
    gone = epochs.commit_batch(spark.createDataFrame([(1, 9, None, C.DELETED)], CHANGE), root, 2, PAYLOAD, ORDER, "stamp")
    assert [r["bound"] for r in (first, empty, gone)] == ["7", "7", "9"] and gone["last_bound"] == "7"
    assert [r["branch"] for r in (first, empty, gone)] == ["updates_only_branch", "no_updates_no_deletes_branch", "deletes_only_branch"]
    assert [(r["before"], r["after"]) for r in (first, empty, gone)] == [(40, 40), (40, 40), (40, 39)]
    with pytest.raises(ExpectationError):
        epochs.commit_batch(spark.createDataFrame([(None, 1, "x", C.UPDATED)], CHANGE), root, 3, PAYLOAD, ORDER)
    assert [r.epoch for r in epochs.epoch_log(spark, root).collect()] == [0, 1, 2]


def test_batch_is_read_once(spark, tmp_path):
    """The changes are computed by the write of the routed files alone; counts and net changes come from that."""
    root = str(tmp_path)
    buckets.create_snapshot(base(spark), root, "id", 4)
    seen = spark.sparkContext.accumulator(0)
    batch = make_batch(random.Random(8), 1)

    def count(part):
        for r in part:
            seen.add(1)
            yield r

    frame = spark.createDataFrame(spark.sparkContext.parallelize(batch, 3).mapPartitions(count), CHANGE)
    record = epochs.commit_batch(frame, root, 0, PAYLOAD, ORDER, "stamp")
    assert seen.value == len(batch) and record["updated"] + record["deleted"] == len(batch)


def test_stream_of_several_files(spark, tmp_path):
    make, inbox, root = random.Random(5), f"{tmp_path}/inbox", f"{tmp_path}/root"
    state = {i: (0, "base") for i in range(40)}
    buckets.create_snapshot(base(spark), root, "id", 4)
    for n in range(4):
        batch = make_batch(make, n)
        state = applied(state, batch)
        spark.createDataFrame(batch, CHANGE).coalesce(1).write.mode("append").json(inbox)
        if n in (1, 3):  # two micro-batches in each start of the query
            epochs.commit_stream(stream_harvest(spark, inbox, CHANGE, "json", files_per_trigger=1), root, PAYLOAD, ORDER).awaitTermination()
    assert rows(buckets.read_snapshot(spark, root)) == sorted((i, *row) for i, row in state.items())
    log = epochs.epoch_log(spark, root).orderBy("epoch").collect()
    assert [r.epoch for r in log] == [0, 1, 2, 3] and [r.before for r in log][1:] == [r.after for r in log][:-1]


OAI = """<record><header{}><identifier>oai:x:{}</identifier><datestamp>{}</datestamp><setSpec>s</setSpec></header>{}</record>"""
MARC = """<metadata><record xmlns="http://www.loc.gov/MARC21/slim"><leader>l</leader><controlfield tag="001">{}</controlfield>{}</record></metadata>"""


def test_incremental_run(spark, tmp_path):
    def harvest(name, *records):
        os.makedirs(f"{tmp_path}/{name}")
        with open(f"{tmp_path}/{name}/1.xml", "w") as out:
            out.write("<collection>" + "".join(records) + "</collection>")
        return f"{tmp_path}/{name}"

    parents = harvest("parents", OAI.format("", 5, "2024-01-01T00:00:00Z", MARC.format(5, '<datafield tag="774" ind1=" " ind2=" "><subfield code="w">9913811</subfield></datafield>')))
    day = "2024-01-0{}T00:00:00Z"
    first = harvest("first", *(OAI.format("", i, day.format(2), MARC.format(i, "")) for i in (9913811, 22)), OAI.format(' status="deleted"', 33, day.format(3), ""), OAI.format("", 44, day.format(9), MARC.format(44, "")))
    root, state = f"{tmp_path}/root", spark.createDataFrame([("t_FROM", "2024-01-01T00:00:00Z", 0)], "key string, value string, version long")
    snapshot = spark.createDataFrame([("33", "2024-01-01 00:00:00", [])], "record_id string, datestamp string, datafield array<struct<tag:string,ind1:string,ind2:string,subfield:array<struct<code:string,value:string>>>>")
    buckets.create_snapshot(snapshot.withColumn("datestamp", F.col("datestamp").cast("timestamp_ntz")), root, "record_id", 4)
    run = lambda version, routed: harvest_into(spark, first, parents, root, state, "t", "2024-01-01T00:00:00", "2024-01-05T00:00:00", version, f"{tmp_path}/{routed}")
    record, after = run(0, "routed")
    assert (record["updated"], record["deleted"], record["before"], record["after"], record["branch"]) == (2, 1, 1, 2, "updates_and_deletes_branch")
    kept = {r.record_id: r.datafield for r in buckets.read_snapshot(spark, root).collect()}
    assert set(kept) == {"9913811", "22"} and [f.tag for f in kept["9913811"]] == ["ADF"] and kept["22"] == []
    assert {r.key: r.value for r in after.collect()} == {"t_FROM": "2024-01-05T00:00:00", "t_LAST_FROM": "2024-01-01T00:00:00"}
    assert sorted(d for d in os.listdir(f"{tmp_path}/routed") if "=" in d) == ["change=deleted", "change=new-updated"]
    assert run(0, "again")[0] == record and not os.path.exists(f"{tmp_path}/again")


def test_emptied_dirs(spark):
    dirs = spark.createDataFrame([(p,) for p in ("a", "a/b", "a/b/c", "a/d", "e", "e/f", "g")], "path string")
    files = spark.createDataFrame([("a/d/x",), ("top",), ("g/y",), ("g/z",)], "path string")
    assert sorted(r.path for r in emptied_dirs(dirs, files).collect()) == ["a/b", "a/b/c", "e", "e/f"]
    assert emptied_dirs(dirs, files.limit(0)).count() == 7
    with pytest.raises(Exception, match="more than 2 levels"):
        emptied_dirs(dirs, files, most_levels=2).collect()


def test_move_conflicts(spark):
    moves = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "d"), ("d", "c"), ("e", "e"), ("f", "g"), ("f", "g"), ("h", "e")], "key string, moved_to string")
    assert sorted(map(tuple, move_conflicts(moves).collect())) == [("a", "x", "same_target"), ("b", "x", "same_target"), ("c", "d", "occupied"), ("d", "c", "occupied")]


def test_top_rows_are_cut_before_the_shuffle(spark):
    """The plan limits each task's rows of a ledger below the exchange; equal and null ledgers and short ones work."""
    items = spark.createDataFrame([(x, p) for x, n in (("a", 50), (None, 3), ("b", 1)) for p in range(n)], "ledger string, pos long")
    assert {tuple(r) for r in last_cut(items, 2).collect()} == {("a", 48), (None, 1), ("b", 0)}
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy("ledger").orderBy(F.col("pos").desc()))
    plan = items.withColumn("_at", place).filter("_at <= 2")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_two_publishers_of_one_version(spark, tmp_path):
    root = str(tmp_path)
    publish_snapshot(base(spark), root, "one", "live", 1)
    publish_snapshot(base(spark), root, "one", "live", 1)  # a rerun of the same one
    with pytest.raises(commits.CommitConflict):
        publish_snapshot(base(spark, 3), root, "two", "live", 1)
    assert read_snapshot(spark, root, "live").count() == 40
    publish_snapshot(base(spark, 3), root, "two", "live", 2)
    assert read_snapshot(spark, root, "live").count() == 3


def test_drops_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    """Each drop of the epochs query has a file for each task that reads line items, and is one epoch."""
    from workload import commits as W

    part = F.col("id")
    orders = spark.range(20).select(part.alias("o_orderkey"), F.timestamp_seconds(part).cast("timestamp_ntz").alias("o_orderdate"), part.alias("o_custkey"), part.cast("double").alias("o_totalprice"))
    lines = spark.range(0, 400, 1, 4).select(
        (part % 25).alias("l_orderkey"), part.alias("l_partkey"), part.alias("l_suppkey"), (part % 7).cast("int").alias("l_linenumber"),
        part.cast("double").alias("l_extendedprice"), F.lit("R").alias("l_returnflag"), F.when(part % 5 == 0, "F").otherwise("O").alias("l_linestatus"),
        F.timestamp_seconds(part).cast("timestamp_ntz").alias("l_shipdate"),
    )
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(W, "shared_path", lambda spark, label: f"{tmp_path}/{label}")
    monkeypatch.setattr(W, "BUCKETS", 4)
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 30))  # a task a file
    log = epochs.epoch_log(spark, W.epochs(spark, str(tmp_path))).orderBy("epoch").collect()
    spark.conf.unset("spark.sql.files.openCostInBytes")
    drops = spark.read.parquet(f"{tmp_path}/inbox").groupBy(F.input_file_name().alias("file"), (F.col("l_linenumber") % 3).alias("drop")).count().collect()
    assert sorted({r["drop"] for r in drops}) == [0, 1, 2] and len({r["file"] for r in drops}) == len(drops) == 12
    assert [r.epoch for r in log] == [0, 1, 2] and [r.updated + r.deleted for r in log] == [sum(r["count"] for r in drops if r["drop"] == i) for i in range(3)]
