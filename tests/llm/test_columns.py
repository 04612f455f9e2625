"""Columns of the input come back as they were, whatever their names, and empty tables give empty results."""

import pytest

pytest.importorskip("bindery.llm")

import corpus_pipeline  # noqa: E402
from bindery.llm import (  # noqa: E402
    byte_bpe, fingerprints, jaccard_join, length_histogram, neighbours, page_text, preferences, secret_scan, sharding, suffix_search, toxicity,
)
from bindery.llm.queries import vocabulary  # noqa: E402

# Names that operators use for columns of their own, and names that need quotes.
NAMES = [
    "a.b", "a`b", "_text", "_maybe", "_node", "_first", "_winner", "_in0", "in0", "own0", "own3", "_kept_score", "score", "predicted", "n_words", "n_hit", "n_items",
    "items_sha256", "contaminated", "longest_match", "hit_bits", "hit_items", "row", "secrets", "Score",
]
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu"
ROWS = [(1, WORDS), (2, WORDS), (3, None), (4, ""), (5, "password = hunter2hunter2 and some more words to read here"), (6, "the item that the benchmark holds word by word in full today")]


@pytest.fixture(scope="module")
def given(shared_spark):
    benchmark = shared_spark.createDataFrame([("b1", ROWS[5][1])], "item_id string, text string")
    labels = shared_spark.createDataFrame([(i, 0, 1) for i in range(1, 7)], "doc_id long, toxic int, quality int")
    return benchmark, labels


def own_columns(spark, names):
    fields = ", ".join("`" + n.replace("`", "``") + "` string" for n in names)
    return spark.createDataFrame([(i, t, *[f"{n} {i}" for n in names]) for i, t in ROWS], f"doc_id long, text string, {fields}")


@pytest.mark.parametrize("stage", ["toxicity", "copies", "benchmark", "secrets"])
@pytest.mark.parametrize("names", [[n for n in NAMES if n != "Score"], ["Score"]])
def test_own_columns_come_back(shared_spark, given, names, stage):
    benchmark, labels = given
    docs = own_columns(shared_spark, names)
    made = {
        "toxicity": lambda: toxicity.without_toxic(docs, labels), "copies": lambda: jaccard_join.one_of_each(docs),
        "benchmark": lambda: suffix_search.decontaminate(docs, benchmark), "secrets": lambda: secret_scan.redact(docs),
    }[stage]()
    left = {"toxicity": {1, 2, 3, 4, 5, 6}, "copies": {1, 3, 4, 5, 6}, "benchmark": {1, 2, 3, 4, 5}, "secrets": {1, 2, 3, 4, 5, 6}}[stage]
    assert made.columns == docs.columns and made.dtypes == docs.dtypes
    found = {r[0]: tuple(r)[1:] for r in made.collect()}
    assert set(found) == left
    for i, text in ROWS:
        if i in left:
            assert found[i][1:] == tuple(f"{n} {i}" for n in names)
            assert stage == "secrets" and i == 5 or found[i][0] == text


def test_kept_copy_is_defined(shared_spark):
    """Rows with one id and one set: the kept one does not depend on how rows lie in partitions."""
    rows = [(1, WORDS, f"v{i}") for i in range(40)]
    kept = [
        jaccard_join.one_of_each(shared_spark.createDataFrame(given, "doc_id long, text string, v string").repartition(n)).collect()
        for given, n in ((rows, 1), (rows[::-1], 7))
    ]
    assert len(kept[0]) == 1 and kept[0] == kept[1]


def test_empty_tables(shared_spark, given):
    benchmark, labels = given
    docs = shared_spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    pages = shared_spark.createDataFrame([], "page_id long, url string, html string")
    turns = shared_spark.createDataFrame([], "pair_id long, turn long, role string, text string")
    made = [
        preferences.format_pairs(turns, turns), secret_scan.digest(docs), suffix_search.annotate(docs, benchmark), suffix_search.decontaminate(docs, benchmark.limit(0)),
        length_histogram.suffix_sums(length_histogram.histogram(length_histogram.encoded_lengths(docs, vocabulary()))),
        toxicity.score(docs, toxicity.train(docs, labels)), fingerprints.against_next(docs), page_text.extract(pages), byte_bpe.round_trip(docs, vocabulary()),
        jaccard_join.join_components(docs), jaccard_join.one_of_each(docs),
        sharding.place(docs, "doc_id", {"shard": sharding.lookup_table(shared_spark, ["a", "b"])}),
    ]
    assert [f.count() for f in made] == [0] * len(made)


def test_empty_pipeline(shared_spark, given, tmp_path):
    benchmark, labels = given
    shared_spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(shared_spark, str(tmp_path)).count() == 0


def test_hot_key_is_spread(shared_spark):
    """A third of the rows has one host, path and URL; no partition gets much more than its share, and the order holds."""
    rows = [(i, "x" if i % 3 == 0 else f"k{i:05d}") for i in range(3000)]
    frame = shared_spark.createDataFrame(rows, "id long, key string").repartition(5)
    ordered = neighbours.in_order(frame, ["key", "id"], ["id"], before=True)
    sizes = [len(p) for p in ordered.rdd.glom().collect()]
    assert max(sizes) <= 2 * 3000 / len(sizes)
    own = sorted((r["_bucket"], r["key"], r["id"]) for r in ordered.where("_ghost = 0").collect())
    assert [(k, i) for _, k, i in own] == sorted((k, i) for i, k in rows)


def test_pages_of_one_url(shared_spark):
    """Every page of a URL that a third of all pages have is returned once."""
    rows = [(i, "http://h/p" if i % 3 == 0 else f"http://h/{i}", f"<p>line {i}</p><p>shared</p>") for i in range(300)] + [(None, None, None)]
    made = page_text.extract(shared_spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)).collect()
    assert len(made) == 301 and {r["page_id"]: r["url"] for r in made} == {r[0]: r[1] for r in rows}
    assert all(f"line {r['page_id']}" in r["text"] for r in made if r["page_id"] is not None)
