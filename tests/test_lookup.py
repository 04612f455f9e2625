import pytest
from pyspark.sql import functions as F

import records as R
from bindery.functions.packed_xml import pack_fields, parse_field, split_fields
from bindery.operators import lookup as L
from bindery.sinks.files import write_lookup, write_marcxml
from bindery.sources.drops import read_lookup
from bindery.sources.xml import read_marcxml


@pytest.fixture(scope="module")
def parents(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("parents") / "parents.xml"
    path.write_text(R.PARENTS)
    return read_marcxml(spark, str(path)).cache()


@pytest.fixture(scope="module")
def children(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("children") / "children.xml"
    path.write_text(R.CHILDREN)
    return read_marcxml(spark, str(path)).cache()


def values(fields):
    return [(f["tag"], [s["value"] for s in f["subfield"]]) for f in fields]


def test_lookup_rows(parents):
    rows = L.build_lookup(parents.filter(F.col("record_id") != R.P4)).orderBy("ord").collect()
    assert len(rows) == 9
    assert [r["child_id"] for r in rows if r["parent_id"] == int(R.P2)] == [991031640129703811, 991012069669703811]
    assert L.lookup_shape(L.build_lookup(parents)).first().asDict() == {"rows": 11, "children": 10, "shared_children": 1}


def test_valid_children_only(parents):
    rows = L.explode_children(parents.filter(F.col("record_id") == R.P4)).orderBy("ord").collect()
    assert [r["child_id"] for r in rows] == [9912343811, 993811]
    assert values(rows[0]["fields"]) == [("ADF", [R.P4])]


def test_inherited_fields(parents):
    row = L.build_lookup(parents.filter(F.col("record_id") == R.P1)).first()
    assert row["parent_xml"] == (
        '<datafield xmlns="http://www.loc.gov/MARC21/slim" tag="ITM" ind1=" " ind2=" "><subfield code="a">last item</subfield></datafield>||'
        '<datafield xmlns="http://www.loc.gov/MARC21/slim" tag="HLD" ind1="0" ind2=" "><subfield code="h"> HD72 </subfield></datafield>||'
        f'<marc21:datafield xmlns:marc21="http://www.loc.gov/MARC21/slim" ind1=" " ind2=" " tag="ADF"><marc21:subfield code="a">{R.P1}</marc21:subfield></marc21:datafield>'
    )


def enriched(frame):
    return {r["record_id"]: values(r["datafield"]) for r in frame.collect()}


def test_enrich(parents, children):
    out = enriched(L.enrich_with_parents(children, L.explode_children(parents)))
    assert out == {
        R.CHILD: [("245", ["A & B <i>"]), ("ITM", ["p3 item"]), ("HLD", ["p_remote"]), ("ADF", [R.P3])],
        R.SHARED: [("245", ["shared"]), ("ITM", ["p2 item"]), ("HLD", ["KARDON"]), ("ADF", [R.P2])],
        "991111111113811": [("245", ["alone"])],
        "on123": [("245", ["no number"])],
    }


def test_lookup_file(spark, tmp_path, parents, children):
    write_lookup(L.build_lookup(parents), str(tmp_path / "lookup"))
    read = L.unpack_lookup(read_lookup(spark, str(tmp_path / "lookup")))
    assert read.count() == 11
    assert enriched(L.enrich_with_parents(children, read)) == enriched(L.enrich_with_parents(children, L.explode_children(parents)))


def test_lookup_file_keeps_its_order(spark, tmp_path):
    """Many rows of one child over several files: the first row of the first file wins."""
    rows = spark.range(5000).repartition(6).select(
        (F.col("id") % 3).alias("child_id"), F.col("id").alias("parent_id"), F.lit("<datafield tag='x'/>").alias("parent_xml"),
        (5000 - F.col("id")).alias("ord"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    write_lookup(rows, str(tmp_path / "many"))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(list((tmp_path / "many").glob("*.csv"))) > 1
    first = L.first_match(read_lookup(spark, str(tmp_path / "many"))).collect()
    assert {r["child_id"]: r["parent_id"] for r in first} == {0: 4998, 1: 4999, 2: 4997}


def test_lookup_files_follow_the_text(spark, tmp_path):
    """Each file holds a bounded part of the text, in order, even if a shuffle has one partition."""
    rows = spark.range(2000).select(
        (F.col("id") % 3).alias("child_id"), F.col("id").alias("parent_id"), F.repeat(F.lit("x"), 500).alias("parent_xml"), (2000 - F.col("id")).alias("ord"),
    )
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    write_lookup(rows, str(tmp_path / "parts"), file_bytes=100_000)
    spark.conf.set("spark.sql.shuffle.partitions", before)
    files = sorted((tmp_path / "parts").glob("*.csv"))
    assert len(files) > 5 and max(f.stat().st_size for f in files) < 300_000
    order = [int(line.split(",")[1]) for f in files for line in f.read_text().splitlines()[1:]]
    assert order == list(range(1999, -1, -1))
    first = L.first_match(read_lookup(spark, str(tmp_path / "parts"))).collect()
    assert {r["child_id"]: r["parent_id"] for r in first} == {0: 1998, 1: 1999, 2: 1997}


def test_lookup_file_without_rows(spark, tmp_path, parents, children):
    write_lookup(L.build_lookup(parents.limit(0)), str(tmp_path / "empty"))
    files = list((tmp_path / "empty").glob("*.csv"))
    assert files and files[0].read_text() == "child_id,parent_id,parent_xml\n"
    none = L.unpack_lookup(read_lookup(spark, str(tmp_path / "empty")))
    assert enriched(L.enrich_with_parents(children, none))[R.CHILD] == [("245", ["A & B <i>"])]


def test_pieces_that_do_not_parse_are_dropped(spark):
    good = '<datafield tag="HLD" ind1=" " ind2=" "><subfield code="a">x</subfield></datafield>'
    rows = spark.createDataFrame([(1, 2, f"{good}||<datafield tag=\"ITM\"><broken||{good}")], "child_id long, parent_id long, parent_xml string")
    assert [f["tag"] for f in L.unpack_lookup(rows).first()["fields"]] == ["HLD", "HLD"]
    nodes = L.explode_nodes(rows).orderBy("node_pos").collect()
    assert [n["field"] is None for n in nodes] == [False, True, False]


def test_separator_inside_text(spark):
    """A value that holds the separator is cut there, and both pieces are dropped."""
    field = F.struct(F.lit("HLD").alias("tag"), F.lit(" ").alias("ind1"), F.lit(" ").alias("ind2"),
                     F.array(F.struct(F.lit("a").alias("code"), F.col("v").alias("value"))).alias("subfield"))
    packed = spark.createDataFrame([("a||b",), ('q"<&>',)], "v string").select("v", pack_fields(F.array(field)).alias("x"))
    parsed = packed.select("v", F.transform(split_fields(F.col("x")), parse_field).alias("f")).collect()
    got = {r["v"]: [f and f["subfield"][0]["value"] for f in r["f"]] for r in parsed}
    assert got == {"a||b": [None, None], 'q"<&>': ['q"<&>']}


def test_hot_child_and_hot_record(spark):
    """A third of the lookup names one child, and a third of the records have its id."""
    field = "array<struct<tag:string,ind1:string,ind2:string,subfield:array<struct<code:string,value:string>>>>"
    lookup = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 100).alias("child_id"), F.col("id").alias("parent_id"),
        F.array(F.struct(F.lit("ADF").alias("tag"), F.lit(" ").alias("ind1"), F.lit(" ").alias("ind2"),
                         F.array(F.struct(F.lit("a").alias("code"), F.col("id").cast("string").alias("value"))).alias("subfield"))).alias("fields"),
        (30000 - F.col("id")).alias("ord"),
    )
    records = spark.range(9000).select(
        F.col("id").alias("n"), F.when(F.col("id") % 3 == 0, "7").otherwise((F.col("id") + 100).cast("string")).alias("record_id"),
        F.array().cast(field).alias("datafield"),
    )
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.shuffle.partitions": "40",
    }
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        frame = L.enrich_with_parents(records.repartition(8), lookup).select("n", F.col("datafield")[0]["subfield"][0]["value"].alias("p"))
        out = frame.collect()
        plan = frame._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in small:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert "skew=true" in plan  # the hot id is split over several tasks
    assert len(out) == 9000
    assert all(r["p"] == ("29997" if r["n"] % 3 == 0 else str(r["n"])) for r in out)


def test_marcxml_roundtrip(spark, tmp_path, children):
    write_marcxml(children.withColumn("airflow_record_id", F.col("record_id")), str(tmp_path / "out"))
    back = read_marcxml(spark, str(tmp_path / "out"))
    assert enriched(back) == enriched(children)
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("*.xml"))
    assert f'airflow-record-id="{R.CHILD}"' in text and 'collection xmlns="http://www.loc.gov/MARC21/slim"' in text


def test_one_folder_per_input(spark, tmp_path, children):
    keyed = children.withColumn("name", F.when(F.col("record_id") == R.CHILD, "a").otherwise("b"))
    write_marcxml(keyed, str(tmp_path / "by"), by="name", records_per_file=2)
    assert len(list((tmp_path / "by" / "name=a").glob("*.xml"))) == 1
    assert len(list((tmp_path / "by" / "name=b").glob("*.xml"))) == 2


def test_stream_enriched(spark, tmp_path, parents, children):
    """The lookup join on a stream of records, through the harvest's own step."""
    from bindery.operators.changes import harvest
    from bindery.streaming.apply import stream_harvest

    stamped = children.withColumn("datestamp", F.when(F.col("record_id") == "on123", 1).otherwise(5))
    stamped.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = stream_harvest(spark, str(tmp_path / "in"), stamped.schema)
    found = harvest(stream, since=F.lit(2), transform=lambda df: L.enrich_with_parents(df, L.explode_children(parents)))
    query = found.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "progress")).trigger(availableNow=True)
    query.start(str(tmp_path / "out")).awaitTermination()
    out = enriched(spark.read.parquet(str(tmp_path / "out")))
    assert out[R.CHILD][1:] == [("ITM", ["p3 item"]), ("HLD", ["p_remote"]), ("ADF", [R.P3])] and "on123" not in out and len(out) == 3
