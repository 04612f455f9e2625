"""What bounds the memory of the similarity join changes nothing else."""

from __future__ import annotations

import pytest

from bindery.llm import common, jaccard_join


def test_batch_rows_are_set_back(spark):
    before = spark.conf.get(common.BATCH_ROWS)
    with pytest.raises(ZeroDivisionError):
        with common.rows_per_batch(spark, 7):
            assert spark.conf.get(common.BATCH_ROWS) == "7"
            with common.rows_per_batch(spark, 9):
                assert spark.conf.get(common.BATCH_ROWS) == "7"
            1 / 0
    assert spark.conf.get(common.BATCH_ROWS) == before


def test_survey_counts_in_chunks(spark, monkeypatch):
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(words), " ".join(words[10:]), " ".join(words[20:30]), " ".join(words), "one two", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)

    def surveyed():
        rows = jaccard_join.survey(docs, "doc_id", "text", 5).collect()
        return {r.a: (r.b, r.n) for r in rows if r.kind == 0}, sorted(r.b for r in rows if r.kind == 1)

    members, counts = surveyed()
    assert [members[i][1] for i in range(7)] == [36, 26, 6, 36, 1, 0, 0]
    assert members[0][0] == members[3][0]
    # Shingles 10 to 35 are in both long texts, 20 to 25 in the short one too; equal sets count once.
    assert counts == [2] * 20 + [3] * 6
    monkeypatch.setattr(jaccard_join, "CHUNK_TOKENS", 8)  # grows to the first set; the next two share a chunk
    assert surveyed() == (members, [2] * 6)
    monkeypatch.setattr(jaccard_join, "CHUNK_TOKENS", 64)  # the first two sets share a chunk, the other two the next
    assert surveyed() == (members, [2] * 26 + [2] * 6)
