import io
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import records as R
from bindery.operators import files as O
from bindery.plans import jobs
from bindery.plans.thesis import xoai_to_marc
from bindery.sources.archives import _record_slices, read_archives
from bindery.sources.drops import list_files, read_csv_drop, read_json_drop
from bindery.sources.xml import read_marcxml, read_oai_marcxml, read_xoai


def test_listing(spark, tmp_path):
    for name in ("in/alma_1", "in/alma_2", "in/alma/3", "in/other", "out/alma_9"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("xy")
    keys = lambda *a: [r["key"] for r in O.listing_order(list_files(spark, str(tmp_path), *a)).collect()]
    assert keys("in/alma") == ["in/alma_1", "in/alma_2"]
    assert keys("in/alma", "") == ["in/alma/3", "in/alma_1", "in/alma_2"]
    (tmp_path / "in/in").mkdir()
    (tmp_path / "in/in/x").write_text("z")
    assert "in/x" in {r["key"] for r in list_files(spark, str(tmp_path / "in"), "", "").collect()}
    row = list_files(spark, str(tmp_path), "out/").first()
    assert row["size"] == 2 and abs(row["mtime"] - datetime.now()) < timedelta(days=1)


@pytest.mark.parametrize("names, stem, newest", [
    (["alma_bibs__1234_test_1", "alma_bibs__1235_test_1", "alma_bibs__1235_test_2", "alma_bibs__12340_test_1"], "", 12340),
    (["alma_bibs__boundwith2_1234_test_1", "alma_bibs__boundwith2_1235_test_2", "alma_bibs__boundwith_12340_test_1"], "", 12340),
])
def test_newest(spark, names, stem, newest):
    files = spark.createDataFrame([(n,) for n in names], "key string")
    assert O.newest_batch(files).first()["newest"] == newest


def test_candidates(spark):
    names = ["alma_bibs__2020050503_1_new.xml", "alma_bibs__2020050503_2_new.xml", "alma_bibs__2019010101_1", "other", "alma_bibs__20200505031_3"]
    files = spark.createDataFrame([(n,) for n in names], "key string")
    assert [r["key"] for r in O.batch_candidates(files).collect()] == ["alma_bibs__20200505031_3"]
    assert O.batch_candidates(files.filter(~F.endswith("key", F.lit("_3")))).count() == 2
    with pytest.raises(Exception, match="no matching files"):
        O.batch_candidates(files.filter("key = 'other'")).collect()
    with pytest.raises(Exception, match="no datestamps"):
        O.oldest_datestamp(files.filter("key = 'other'")).collect()
    with pytest.raises(Exception, match="no batch stamp"):
        O.newest_batch(spark.createDataFrame([("alma_bibs__20x_1",)], "key string")).collect()


def test_age(spark):
    now = datetime(2024, 3, 1)
    ages = [timedelta(days=30), timedelta(days=30, hours=23), timedelta(days=31)]
    files = spark.createDataFrame([("a/b", now - a, i) for i, a in enumerate(ages)], "key string, mtime timestamp_ntz, size long")
    at = F.lit(now).cast("timestamp_ntz")
    assert [r["size"] for r in O.expired_files(files, at).collect()] == [2]
    assert O.expired_files(files, at, least=3).count() == 0 and O.expired_files(files, at, most=1).count() == 0


def test_drops(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,y\n1,"say ""hi"", all"\n')
    (tmp_path / "b.json").write_text('{"x": 2, "y": "json"}\n')
    (tmp_path / "c.txt").write_text("x,y\n3,text\n")
    rows = lambda frame: [tuple(r) for r in frame.collect()]
    assert rows(read_csv_drop(spark, str(tmp_path), "x int, y string")) == [(1, 'say "hi", all')]
    assert rows(read_json_drop(spark, str(tmp_path), "x int, y string")) == [(2, "json")]


@pytest.mark.parametrize("text, pieces", [
    ("<c><record>a</record>\n<record n='>'/><record><x/></record></c>", ["<record>a</record>", "<record n='>'/>", "<record><x/></record>"]),
    ("<c><record/><record></record ></c>", ["<record/>", "<record></record >"]),
    ("<c><!-- <record>no</record> --><w><record>deep</record></w><m:record xmlns:m='u'><![CDATA[</record>]]></m:record></c>", ["<m:record xmlns:m='u'><![CDATA[</record>]]></m:record>"]),
    ("<c/>", []),
])
def test_record_slices(text, pieces, monkeypatch):
    from bindery.sources import archives

    assert list(_record_slices(io.BytesIO(text.encode()), "record")) == pieces
    for size in (1, 3, 7):
        monkeypatch.setattr(archives, "BLOCK", size)
        assert list(_record_slices(io.BytesIO(text.encode()), "record")) == pieces


def test_record_slices_in_another_encoding():
    text = '<?xml version="1.0" encoding="ISO-8859-1"?><c><record>é</record></c>'
    assert list(_record_slices(io.BytesIO(text.encode("latin-1")), "record")) == ["<record>é</record>"]


def test_archives_equal_plain_files(spark, tmp_path):
    (tmp_path / "parents.xml").write_text(R.PARENTS)
    R.archive(tmp_path / "parents.tar.gz", ("a.xml", R.PARENTS), ("b.xml", R.CHILDREN))
    packed = read_archives(spark, str(tmp_path / "parents.tar.gz"))
    plain = read_marcxml(spark, str(tmp_path / "parents.xml"))
    columns = ["record_id", "leader", "controlfield", "datafield"]
    assert packed.orderBy("rec_pos").select(columns).collect()[:4] == plain.orderBy("rec_pos").select(columns).collect()
    assert packed.count() == 8


def test_bad_xml_stops_the_job(spark, tmp_path):
    (tmp_path / "bad.xml").write_text("<collection><record><leader>x</record></collection>")
    with pytest.raises(Exception):
        read_marcxml(spark, str(tmp_path / "bad.xml")).collect()
    (tmp_path / "good.xml").write_text(R.CHILDREN)
    both = read_marcxml(spark, [str(tmp_path / "bad.xml"), str(tmp_path / "good.xml")], mode="PERMISSIVE").cache()
    assert both.filter("rejected IS NULL").count() == 4
    rejects = both.filter("rejected IS NOT NULL").collect()
    assert len(rejects) == 1 and "<leader>x" in rejects[0]["rejected"] and rejects[0]["src_key"].endswith("bad.xml")


def test_full_rebuild(spark, tmp_path):
    R.archive(tmp_path / "records.tar.gz", ("a.xml", R.CHILDREN))
    R.archive(tmp_path / "parents.tar.gz", ("a.xml", R.PARENTS))
    out = jobs.full_rebuild(spark, str(tmp_path / "records.tar.gz"), str(tmp_path / "parents.tar.gz"), str(tmp_path / "out"))
    tags = {r["record_id"]: [f["tag"] for f in r["datafield"]] for r in out.collect()}
    assert tags[R.CHILD] == ["245", "ITM", "HLD", "ADF"] and tags["on123"] == ["245"] and len(tags) == 4


def test_oai_and_incremental_harvest(spark, tmp_path):
    inner = lambda *a: f'<record xmlns="{R.NAMESPACE}">' + R.marc(*a).removeprefix("<record>")
    (tmp_path / "parents.xml").write_text(
        R.oai_collection(R.oai(R.P3, "2020-01-01T00:00:00Z", ["bw"], inner(R.P3, R.field("ITM", ("a", "i")), R.field("774", ("w", R.CHILD)))))
    )
    (tmp_path / "harvest.xml").write_text(
        R.oai_collection(
            R.oai(R.CHILD, "2020-06-08T10:00:00Z", ["blacklight"], inner(R.CHILD, R.field("245", ("a", "t")))),
            R.oai("9", "2020-06-08T11:00:00Z", ["blacklight"], status="deleted"),
            R.oai("8", "2019-01-01T00:00:00Z", ["blacklight"], inner("8")),
            R.oai("7", "2020-06-08T11:00:00Z", ["elsewhere"], inner("7")),
        )
    )
    read = read_oai_marcxml(spark, str(tmp_path / "harvest.xml"))
    row = read.filter("deleted").first()
    assert row["oai_id"] == "oai:x:9" and row["sets"] == ["blacklight"] and row["datestamp"] == datetime(2020, 6, 8, 11)
    snapshot = read.limit(0).select("record_id", "datafield").unionByName(
        spark.createDataFrame([("9",), ("1",)], "record_id string").withColumn("datafield", F.array().cast(read.schema["datafield"].dataType))
    )
    bound = lambda text: F.expr(f"timestamp_ntz'{text}'")
    after, counts = jobs.incremental_harvest(
        spark, str(tmp_path / "harvest.xml"), str(tmp_path / "parents.xml"), snapshot, bound("2020-06-08"), bound("2020-06-09"), ["blacklight"]
    )
    got = {r["record_id"]: [f["tag"] for f in r["datafield"]] for r in after.collect()}
    assert got == {"1": [], R.CHILD: ["245", "ITM", "ADF"]}
    assert counts.first().asDict() == {"batch": "harvest", "updated": 1, "deleted": 1, "branch": "updates_and_deletes_branch"}


def full_thesis():
    leaf = lambda *v: R.el("none", R.val(*v))
    dc = [
        R.el("contributor", R.el("advisor", leaf("Hiller, Matthew L.")), R.el("committeemember", leaf("Welsh, Wayne N.", "Belenko, Steven R."))),
        R.el("creator", R.el("none", R.val("Abdel-Salam, Sami"), R.val("98d0", name="authority"))),
        R.el("date", R.el("accessioned", leaf("2020-10-20T13:33:12Z")), R.el("issued", leaf("2011"))),
        R.el("identifier", R.el("uri", leaf("http://hdl.handle.net/20/620")), R.el("filename", leaf("abc_1.pdf")), R.el("proqst", leaf("10715"))),
        R.el("description", R.el("abstract", leaf("  An\n abstract ")), R.el("department", leaf("Criminal Justice")), R.el("degree", leaf("Ph.D."))),
        R.el("format", R.el("extent", leaf("191 pages"))), R.el("language", R.el("iso", leaf("eng"))),
        R.el("relation", R.el("doi", leaf("http://dx.doi.org/10.34944/dspace/602"))),
        R.el("rights", leaf("IN COPYRIGHT"), R.el("uri", leaf("http://r/"))), R.el("subject", leaf("Criminology", "a , b  c, ")),
        R.el("title", leaf("The Art: A Study")),
    ]
    file = lambda text: R.el("bitstream", R.val("f.pdf", name="name"), R.val(text, name="description"))
    bundles = R.el("bundles", R.el("bundle", R.el("bitstreams", file("Extracted text"))), R.el("bundle", R.el("bitstreams", file("Supplemental File"))))
    return R.thesis(*dc, bundles=bundles)


def lines(row):
    return [f["tag"] + f["ind1"] + f["ind2"] + "".join(f"${s['code']}{s['value']}" for s in f["subfield"]) for f in row["datafield"]]


def test_thesis(spark, tmp_path):
    (tmp_path / "t.xml").write_text(full_thesis())
    read = read_xoai(spark, str(tmp_path / "t.xml"))
    assert read.first()["oai_id"] == "oai:s:1" and read.first()["sets"] == ["com_10", "col_11"]
    row = xoai_to_marc(read, F.lit("2024-02-01").cast("date")).first()
    assert [f["value"] for f in row["controlfield"]][2] == "240201s2011####pau#####obm###000#0#eng#d"
    assert lines(row) == [
        "0248 $aabc_1", "035  $a(MiAaPQD)10715", "035  $a(PPT)10_34944_dspace_602", "040  $aTEU$beng$cTEU$erda",
        "1001 $aAbdel-Salam, Sami$eauthor. ", "24514$aThe Art : $b A Study /$cby Sami Abdel-Salam.",
        "264 1$a[Philadelphia, Pennsylvania] :$bTemple University Libraries, $c2011. ", "300  $a1 online resource (191 pages).",
        "336  $atext$2rdacontent", "337  $acomputer$2rdamedia", "338  $aonline resource$2rdacarrier",
        "502  $bPh.D.$cTemple University$d2011", "500  $aDepartment: Criminal Justice.", "520  $aAn abstract",
        "504  $aIncludes bibliographical references.", "5060 $aFree-to-read$fUnrestricted online access$2star$5PPT",
        "540  $aIN COPYRIGHT$uhttp://r/", "653  $aCriminology", "653  $aa ", "653  $ab c", "653  $a",
        "690 4$aCriminal Justice$xTemple University theses.", "690 4$aTemple University$xTheses.", "655 7$aAcademic theses.$2lcgft",
        "7001 $aHiller, Matthew L.,$eadvisor. ", "7001 $aWelsh, Wayne N.,$ecommittee member. ", "7001 $aBelenko, Steven R.,$ecommittee member. ",
        "97308$tTemple University Theses and Dissertations", "85640$uhttp://dx.doi.org/10.34944/dspace/602$zAccess online resource.",
        "902  $aIncludes Supplemental File",
    ]


def test_bare_thesis(spark, tmp_path):
    """Nothing but an empty first author, a second one, and an embargo."""
    leaf = lambda *v: R.el("none", R.val(*v))
    (tmp_path / "t.xml").write_text(
        R.thesis(R.el("creator", leaf("", "Doe, Jane"), R.el("orcid", leaf("0000-1"))), R.el("embargo", R.el("lift", leaf("2030"))))
    )
    row = xoai_to_marc(read_xoai(spark, str(tmp_path / "t.xml")), F.lit("2024-02-01").cast("date")).first()
    found = lines(row)
    assert [l for l in found if l[:3] in ("100", "700")] == ["7001 $aDoe, Jane,$eauthor. $0(orcid)0000-1"]
    assert [l for l in found if l[:3] in ("024", "035", "245", "856", "902")] == [
        "035  $a(PPT)", "24510$a /$cby.", "85640$u$zAccess online resource.", "902  $aLanguage check: 'und'", "902  $aEMBARGO LIFT: 2030"
    ]


def test_thesis_job(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "t.xml").write_text(full_thesis())
    mapped = jobs.thesis_mapping(
        spark, str(tmp_path / "in"), str(tmp_path / "out"), F.lit("2024-02-01").cast("date"), str(tmp_path / "cleaned")
    )
    cleaned = next((tmp_path / "cleaned").glob("*.xml")).read_text()
    assert "xmlns" not in cleaned and cleaned.count("<metadata>") == 1 and '<element name="dc">' in cleaned
    same = lambda path: read_xoai(spark, str(path)).drop("src_key", "rec_pos").collect()
    assert same(tmp_path / "cleaned") == same(tmp_path / "in")
    back = read_marcxml(spark, str(tmp_path / "out"))
    assert lines(back.first()) == lines(mapped.first())
    assert 'airflow-record-id="oai:s:1"' in next((tmp_path / "out").glob("*.xml")).read_text()


def test_mapping_is_one_narrow_stage(spark, tmp_path):
    import contextlib

    (tmp_path / "t.xml").write_text(full_thesis())
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        xoai_to_marc(read_xoai(spark, str(tmp_path / "t.xml")), F.current_date()).explain()
    assert "Exchange" not in out.getvalue()


def test_deeper_elements_are_an_error_or_kept(spark, tmp_path):
    deep = R.el("a", R.el("b", R.el("c", R.el("none", R.val("v")))))  # below dc: the fifth level holds the value
    (tmp_path / "t.xml").write_text(R.thesis(deep))
    with pytest.raises(Exception, match="deeper than 4 levels"):
        read_xoai(spark, str(tmp_path / "t.xml")).collect()
    assert "<" in str(read_xoai(spark, str(tmp_path / "t.xml"), mode="PERMISSIVE").first()["element"])
    jobs.write_cleaned(read_xoai(spark, str(tmp_path / "t.xml"), levels=6), str(tmp_path / "copy"))
    same = lambda path: read_xoai(spark, str(path), levels=6).drop("src_key", "rec_pos").collect()
    assert same(tmp_path / "copy") == same(tmp_path / "t.xml")
