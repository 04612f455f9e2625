"""Importance resampling, quality rules and the filter audit against plain code."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import pytest

pytest.importorskip("bindery.llm")

import numpy as np  # noqa: E402
import pyarrow as pa  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from bindery.llm import filter_audit, importance, quality_rules  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


@pytest.fixture(scope="module")
def rows():
    make = random.Random(11)
    words = ["the", "of", "and", "Water", "été", "mit", "stone", "日本", "río", "x1", "don't", "LOUD", "50%", "a|b", "naïve"]
    out = []
    for i in range(90):
        text = " ".join(make.choice(words) for _ in range(make.choice([3, 30, 70, 210, 260])))
        if i % 4 == 0:
            text = text.replace(" the ", "\nthe ").replace(" and ", " \n\tand ")
        if i % 7 == 0:
            text = "same line of text\n" * 12 + text
        out.append(text)
        if i % 9 == 0:
            out.append(text)
    out += [None, "", " \t\n", "one", "TWO WORDS", "long" * 20_000, "spam egg ham " * 9_000, "#" * 3_000]
    found = [(i, t, make.choice(["en", "fr", "de", None]), "s", 1) for i, t in enumerate(out)]
    return found + [found[0], (None, out[0], "en", None, None), (None, None, None, None, None), (7, "another text of the same id", "", None, None)]


@pytest.fixture(scope="module")
def docs(shared_spark, rows):
    clash = {c: F.lit("own") for c in ("mask", "part", "digest", "first", "kind", "buckets", "score", "rank", "m", "row", "a.b")}
    return shared_spark.createDataFrame(rows, DOCS).withColumns(clash)


def test_crc_of_spans():
    make, crc = random.Random(4), importance.PositionCrc()
    for _ in range(30):
        data = bytes(make.randrange(256) for _ in range(400))
        cuts = [sorted(make.sample(range(401), 2)) for _ in range(25)]
        begin, end = (np.array(x) for x in zip(*cuts))
        assert crc(np.frombuffer(data, np.uint8), begin, end).tolist() == [zlib.crc32(data[a:b]) for a, b in cuts]
    assert crc(np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)).tolist() == []
    whole = np.frombuffer(b"ab" * 50_000, np.uint8)
    assert crc(whole, np.array([0]), np.array([len(whole)])).tolist() == [zlib.crc32(whole.tobytes())]


@pytest.mark.parametrize("longest", [1, 3])
def test_features(longest):
    texts = ["One two-three\tfour", None, "", "é", "x" * 200, "ends", "Joins not", "日本 a a a"]
    words, found, ends = importance.Features(longest, 10_000)(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        w = LETTERS.findall((t or "").translate(LOWER))
        want = [zlib.crc32(" ".join(w[k : k + n]).encode()) % 10_000 for n in range(1, longest + 1) for k in range(len(w) - n + 1)]
        assert words[i] == len(w) and found[ends[i] : ends[i + 1]].tolist() == want


def draw(rows, target, k=10_000, least=20, seed=2024):
    read = lambda t: [zlib.crc32(w.encode()) % k for w in LETTERS.findall((t or "").translate(LOWER))]
    s, t = collections.Counter(b for r in rows for b in read(r[1])), collections.Counter(b for x in target for b in read(x))
    total_s, total_t = sum(s.values()), sum(t.values())
    out = []
    for r in rows:
        found = read(r[1])
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (total_s + k) / ((s[b] + 1) * (total_t + k)))) for b in found)
        h = int(hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest()[:8], 16)
        out.append([r[0], len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    chosen = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, r in enumerate(chosen[: 10 * len(chosen) // 100]):
        r[4] = place + 1
    return collections.Counter(map(tuple, out))


def test_resampling(shared_spark, docs, rows):
    texts = ["stone water the the", None, "", "río " * 40]
    target = shared_spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "item_id long, text string")
    got = importance.resample(docs, target)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert collections.Counter(map(tuple, got.collect())) == draw(rows, texts)
    assert collections.Counter(map(tuple, importance.resample(docs, target.limit(0)).collect())) == draw(rows, [])
    assert importance.resample(docs.limit(0), target).count() == 0
    few = importance.resample(docs, target, least_words=10**9)
    assert few.where("rank IS NOT NULL").count() == 0 and few.count() == len(rows)


def test_ranks_with_ties(shared_spark):
    """Half of the rows share one score; the cut lies within them, and smaller ids win."""
    scores = shared_spark.range(2000).select(F.col("id").alias("doc_id"), F.lit(30).alias("n_words"), F.when(F.col("id") % 2 == 0, 5).otherwise(1).cast("long").alias("score"))
    got = importance.ranked(scores, "n_words >= 20").where("rank IS NOT NULL").collect()
    assert sorted((r.rank, r.doc_id) for r in got) == [(i + 1, 2 * i) for i in range(200)]


def test_quality_measures(docs, rows):
    got = quality_rules.judged(docs)
    assert got.columns[: len(docs.columns)] == docs.columns
    want = collections.Counter()
    for r in rows:
        t = r[1] or ""
        w = SPACED.findall(t)
        lines = [x for x in t.split("\n") if SPACED.search(x)]
        seen = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        covered = {i + k for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for k in range(3)}
        want[r[0], len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered), len(w) < 50 or 100 * len(covered) > 50 * len(w)] += 1
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert collections.Counter(map(tuple, got.select(*names).collect())) == want
    assert got.where("base_failed AND kept").count() == 0 and got.where("kept AND size(failed) > 0").count() == 0
    assert quality_rules.judged(docs.limit(0)).count() == 0


def test_quality_table(shared_spark):
    good = " ".join(f"word{i} and stone{i} of place{i}" for i in range(20))
    loud = "\n".join(f"LINE{i} OF STONE{i} AND WATER{i}" for i in range(20))
    texts = [good, loud, good.replace(" and", " #$"), None]
    docs = shared_spark.createDataFrame([(i, t, 9) for i, t in enumerate(texts)], "doc_id long, text string, kept long")
    out = {r.doc_id: (r.kept, r.failed) for r in quality_rules.judged(docs).collect()}
    assert out == {0: (True, []), 1: (False, ["shouted_lines"]), 2: (False, ["symbols"]), 3: (False, ["few_words"])}
    kept = quality_rules.keep(docs).collect()
    assert [(r.doc_id, r.kept) for r in kept] == [(0, 9)] and quality_rules.keep(docs).columns == docs.columns
    own = quality_rules.judged(docs, rules=[("long", "n_words", "one", None, 100 * 99)], base=())
    assert {r.doc_id: r.kept for r in own.collect()} == {0: False, 1: False, 2: False, 3: True}


def test_quality_runs_without_workers(docs):
    plan = quality_rules.judged(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def brute_audit(rows, labels):
    first, flags = {}, collections.defaultdict(lambda: [False, False])
    for r in rows:
        if r[0] is not None:
            first[r[1] or ""] = min(first.get(r[1] or "", r[0]), r[0])
    for i, quality, toxic in labels:
        if i is not None:
            flags[i][0] |= quality == 1
            flags[i][1] |= toxic == 1
    found = collections.defaultdict(list)
    for r in rows:
        t = r[1] or ""
        w = SPACED.findall(t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": r[0] is not None and r[0] > first[t]}
        found[r[2] or ""].append(({x for x in "ABCDE" if fails[x]}, *(flags[r[0]] if r[0] is not None else (False, False))))
    out = []
    for part, members in found.items():
        shapley = collections.Counter()
        made = []
        for order in itertools.permutations("ABCDE"):
            left = members
            for step, x in enumerate(order, 1):
                gone = [m for m in left if x in m[0]]
                left = [m for m in left if x not in m[0]]
                shapley[x] += len(gone)
                failing = sum(x in m[0] for m in members)
                made.append((x, (part, "".join(order), step, len(left), len(gone), failing - len(gone), sum(m[0] == {x} for m in members), sum(m[1] for m in gone), sum(m[2] for m in gone))))
        out += [(*row, shapley[x]) for x, row in made]
    return collections.Counter(out)


def test_audit(shared_spark, docs, rows):
    labels = [(i, i % 2, i % 3) for i in range(0, 90)] + [(3, 1, 1), (None, 1, 1), (5, None, None), (10**6, 1, 1)]
    marks = shared_spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert collections.Counter(map(tuple, filter_audit.audit(docs, marks).collect())) == brute_audit(rows, labels)
    assert collections.Counter(map(tuple, filter_audit.audit(docs, marks.limit(0)).collect())) == brute_audit(rows, [])
    assert filter_audit.audit(docs.limit(0), marks).count() == 0


def test_gray_walk():
    make = np.random.default_rng(3)
    for k in range(1, 6):
        counts = make.integers(0, 9, (4, 1 << k, 2))
        states = filter_audit.survivors(counts)
        for active in range(1 << k):
            assert (states[:, active] == counts[:, [m for m in range(1 << k) if not m & active]].sum(axis=1)).all()


def test_other_filters(shared_spark):
    rows = shared_spark.createDataFrame([("p", 1), ("p", 3), ("p", 0), ("q", 2)], "part string, mask int")
    cells = filter_audit.mask_cells(rows, F.col("part"), F.col("mask"), F.lit(True), F.lit(False))
    got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.shapley) for r in filter_audit.orders(cells, "XY").collect()}
    assert len(got) == 8 and got["p", "XY", 1] == (1, 2, 0, 1, 2, 3) and got["p", "XY", 2] == (1, 0, 1, 0, 0, 1) and got["q", "YX", 1] == (0, 1, 0, 1, 1, 2)
    with pytest.raises(ValueError):
        filter_audit.orders(cells, "ABCDEFGH")
