"""Archives streamed by their data source."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import records as R
from bindery.sources.archive_stream import _groups, stream_archives, stream_members
from bindery.sources.archives import read_archives


@pytest.fixture
def folder(tmp_path):
    R.archive(tmp_path / "a.tar.gz", ("a.xml", R.PARENTS), ("b.xml", R.CHILDREN))
    (tmp_path / "deep").mkdir()
    R.archive(tmp_path / "deep" / "b.tar.gz", ("c.xml", R.CHILDREN))
    R.archive(tmp_path / "c.tar.gz", ("d.xml", R.CHILDREN))
    (tmp_path / "_SUCCESS").write_text("")
    return tmp_path


def ordered(df):
    return df.orderBy("src_key", "rec_pos").collect()


def test_streamed_equal_to_whole_values(spark, folder):
    assert ordered(stream_archives(spark, str(folder))) == ordered(read_archives(spark, str(folder)))
    assert ordered(stream_archives(spark, f"file://{folder}")) == ordered(read_archives(spark, str(folder)))
    one = stream_archives(spark, str(folder / "a.tar.gz"))
    assert one.count() == 8 and [r[0] for r in one.select("rec_pos").orderBy("rec_pos").collect()] == list(range(8))


def test_archives_larger_than_a_value_may_be(spark, folder):
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "100")
    try:
        with pytest.raises(Exception, match="(?i)max length|exceed"):
            read_archives(spark, str(folder)).collect()
        assert stream_archives(spark, str(folder)).count() == 16
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")


def test_tasks(spark, folder):
    tasks = lambda **options: stream_members(spark, str(folder), **options).select(F.spark_partition_id()).distinct().count()
    assert tasks(maxPartitionBytes="1") == 3
    assert tasks() == 1
    assert _groups([("a", 4), ("b", 4), ("c", 9), ("d", 1)], 8) == [["a", "b"], ["c"], ["d"]]


def test_streamed_edges(spark, tmp_path):
    assert stream_archives(spark, str(tmp_path)).count() == 0
    with pytest.raises(Exception, match="FileNotFoundError"):
        stream_archives(spark, str(tmp_path / "none")).count()
    R.archive(tmp_path / "a.tar.gz", ("a.xml", R.CHILDREN))
    assert stream_members(spark, str(tmp_path), rowTag="leader").count() == 0
    cut = (tmp_path / "a.tar.gz").read_bytes()
    (tmp_path / "a.tar.gz").write_bytes(cut[: len(cut) // 2])
    with pytest.raises(Exception):
        stream_archives(spark, str(tmp_path)).collect()
