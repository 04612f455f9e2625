"""What bounds the memory of the pipeline's stages: few texts in a batch, and small suffix arrays."""

from __future__ import annotations

import pyarrow as pa
import pytest

import corpus_pipeline
from bindery.llm import common, suffix_search
from test_part_memory import peak_mb, texts


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
@pytest.mark.parametrize("before, after", [("10000", "1000"), ("0", "1000"), ("50", "50")])
def test_stages_hand_out_few_rows(shared_spark, monkeypatch, name, before, after):
    docs = shared_spark.range(2500).selectExpr("id AS doc_id", "'en' AS lang", "'web' AS source", "'some text' AS text")
    # Each operator is replaced by one that tells how many rows its worker gets when the frame is run after the stage.
    def sizes(frame, *_, **__):
        def work(batches):
            for batch in batches:
                n = pa.array([len(batch)] * len(batch), pa.int64())
                yield pa.RecordBatch.from_arrays([*batch.columns, n], names=[*batch.schema.names, "n_tokens"])

        out = frame.coalesce(1).mapInArrow(work, frame.schema.add("n_tokens", "long"))
        return out.selectExpr("*", "'' AS ids_sha256", "'' AS decoded_sha256", "array(1) AS ids")

    monkeypatch.setattr(corpus_pipeline, "table", lambda *_: docs)
    monkeypatch.setattr(corpus_pipeline, "vocabulary", lambda: b"")
    for module, function in (("toxicity", "without_toxic"), ("jaccard_join", "one_of_each"), ("suffix_search", "decontaminate"), ("secret_scan", "redact"), ("byte_bpe", "round_trip")):
        monkeypatch.setattr(getattr(corpus_pipeline, module), function, sizes)
    own = shared_spark.conf.get(common.BATCH_ROWS)
    try:
        shared_spark.conf.set(common.BATCH_ROWS, before)
        rows = dict(corpus_pipeline.STAGES)[name](shared_spark, docs, "").select("doc_id", "n_tokens").collect()
        assert sorted(r.doc_id for r in rows) == list(range(2500)) and max(r.n_tokens for r in rows) == int(after)
    finally:
        shared_spark.conf.set(common.BATCH_ROWS, own)


def test_search_holds_less_and_finds_the_same():
    values = texts(3 << 20)
    rows = [(i, " ".join(values[10 * i].split()[20 * i : 20 * i + 15])) for i in range(20)]
    function = suffix_search.search_work(rows, suffix_search.WINDOW, True)()
    batch = pa.RecordBatch.from_arrays([pa.array(values)], names=["in0"])
    function([pa.array(values[:1])])  # the powers are kept
    peak, bits = peak_mb(function, batch, suffix_search.SHARD_BYTES)
    assert peak < 40
    assert bits == function([batch.column(0)])[0].to_pylist() and sum(any(x) for x in bits) >= 20
