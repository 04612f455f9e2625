"""Listings that start at the folder of their prefix."""

from __future__ import annotations

from bindery.sources.drops import folder_of, list_files


def test_folder_of():
    assert [folder_of(p) for p in ("", "a", "a/", "a/b", "a/b/c.", "x=1/b")] == ["", "", "a", "a", "a/b", "x=1"]
    assert [folder_of(p) for p in ("/a", "a//b", "../a", "_a/b", "a*/b", "a/[b]/c", "a\\\\b/c")] == [""] * 7


def test_only_the_folder_of_the_prefix_is_listed(spark, tmp_path):
    for key in ("a/b1.txt", "a/b2/c.txt", "a/x.txt", "other/a/b3.txt", "b.txt"):
        (tmp_path / key).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / key).write_text(key)
    keys = lambda prefix, **o: sorted(r["key"] for r in list_files(spark, str(tmp_path), prefix, **o).collect())
    assert keys("a/b") == ["a/b1.txt"]
    assert keys("a/b", delimiter="") == ["a/b1.txt", "a/b2/c.txt"]
    assert keys("b") == ["b.txt"]
    assert keys("a/b1.txt/c") == [] and keys("none/b") == []
    opened = list_files(spark, str(tmp_path), "a/b").inputFiles()
    assert opened and all("/other/" not in f and "/a/" in f for f in opened)
    none, some = list_files(spark, str(tmp_path), "none/b"), list_files(spark, str(tmp_path), "a/b")
    assert none.dtypes == some.dtypes
