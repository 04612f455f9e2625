"""How much a worker holds while it encodes or searches a batch of texts."""

from __future__ import annotations

import random
import tracemalloc

import pyarrow as pa
import pytest

from bindery.llm import byte_bpe, common, suffix_search
from bindery.llm.queries import vocabulary


def texts(size: int) -> list[str]:
    """Texts of some ``size`` bytes in all, most words of which recur."""
    make = random.Random(3)
    words = ["".join(make.choices("abcdefghijklmnop", k=make.randrange(2, 9))) for _ in range(2000)]
    out: list[str] = []
    while sum(map(len, out)) < size:
        out.append(" ".join(make.choices(words, k=2000)))
    return out


def peak_mb(function, batch: pa.RecordBatch, limit: int) -> tuple[float, list]:
    """MB that calls on parts of a batch take at most beyond what is there, and their first column."""
    first = []
    tracemalloc.start()
    try:
        for part in common.parts(batch, "in0", limit):
            first += function([part.column(0)])[0].to_pylist()
        return tracemalloc.get_traced_memory()[1] / 1e6, first
    finally:
        tracemalloc.stop()


@pytest.mark.parametrize("name", ["encode", "round_trip"])
def test_encoding_holds_a_small_part(monkeypatch, name):
    given = {}
    monkeypatch.setattr(common, "add_columns", lambda df, inputs, fields, work, limit=common.PART_BYTES: given.update(work=work, limit=limit))
    getattr(byte_bpe, name)(None, vocabulary())
    values = texts(4 << 20)
    function = given["work"]()
    batch = pa.RecordBatch.from_arrays([pa.array(values)], names=["in0"])
    peak, texts_by_part = peak_mb(lambda columns: [pa.array([len(function(columns)[0])])], batch, given["limit"])
    assert peak < 110 and sum(texts_by_part) == len(values) and len(texts_by_part) > 4
    # Cut into parts or not, each text has the same tokens.
    some = pa.RecordBatch.from_arrays([pa.array(values[:40] + ["", None])], names=["in0"])
    whole = function([some.column(0)])[0].to_pylist()
    assert [x for part in common.parts(some, "in0", 20_000) for x in function([part.column(0)])[0].to_pylist()] == whole


def test_search_holds_a_small_shard():
    values = texts(6 << 20)
    rows = [(i, " ".join(values[0].split()[20 * i : 20 * i + 15])) for i in range(20)]
    function = suffix_search.search_work(rows, suffix_search.WINDOW, True)()
    batch = pa.RecordBatch.from_arrays([pa.array(values)], names=["in0"])
    peak, bits = peak_mb(function, batch, suffix_search.SHARD_BYTES)
    assert peak < 150 and len(bits) == len(values) and any(bits[0])
