"""The operators of this subpackage bound to the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindery.llm import (
    byte_bpe, filter_audit, fingerprints, importance, jaccard_join, length_histogram, page_text, preferences, quality_rules, secret_scan,
    sharding, suffix_search, toxicity,
)
from bindery.session import stored

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

VOCABULARY = "byte_bpe_50k.tiktoken"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(path: str | None = None) -> bytes:
    """Content of a rank file, by default the public one; it goes to the tasks with the job."""
    with open(path or public_tokenizers.path(VOCABULARY), "rb") as file:
        return file.read()


@query("op2_secret_scan")
def secret_spans(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secret_scan.digest(docs).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random")


@query("op3_suffix_array_decontamination")
def contaminated_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = suffix_search.annotate(docs, table(spark, sf_dir, "benchmark"))
    return marked.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "longest_match")


@query("op5_toxicity")
def toxic_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", F.col("predicted").cast("int").alias("predicted"))


@query("op8_byte_bpe")
def byte_bpe_round_trip(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return byte_bpe.round_trip(docs, vocabulary()).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query("op9_ngram_jaccard_join")
def similar_documents(spark, sf_dir):
    return jaccard_join.join_components(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op1_preference_formatting", r"""
WITH turns AS (
  SELECT CAST(floor(conv_id / 2) AS BIGINT) AS pair_id, turn, role, text, coalesce(turn, 9223372036854775807) AS place,
         CASE WHEN conv_id % 2 = 0 THEN 'chosen' ELSE 'rejected' END AS side
  FROM conversations WHERE conv_id IS NOT NULL),
both_sides AS (
  SELECT pair_id, place, count(*) FILTER (WHERE side = 'chosen') = 1 AND count(*) FILTER (WHERE side = 'rejected') = 1
         AND count(DISTINCT coalesce(role, chr(1)) || chr(2) || coalesce(text, chr(1))) = 1 AS same
  FROM turns GROUP BY pair_id, place),
cuts AS (SELECT pair_id, min(place) FILTER (WHERE NOT same) AS cut FROM both_sides GROUP BY pair_id),
marked AS (
  SELECT turns.*, cut IS NULL OR place < cut AS shared, '<|im_start|>' || coalesce(role, '') || chr(10) AS head,
         replace(coalesce(text, ''), '<|', '< |') || '<|im_end|>' || chr(10) AS rest
  FROM turns JOIN cuts USING (pair_id))
SELECT pair_id, CASE WHEN shared THEN 'prompt' ELSE side END AS part, turn, role, head || rest AS rendered,
       CAST(CASE WHEN NOT shared AND role = 'assistant' THEN length(head) ELSE 0 END AS BIGINT) AS mask_start,
       CAST(CASE WHEN NOT shared AND role = 'assistant' THEN length(head || rest) - 1 ELSE 0 END AS BIGINT) AS mask_end
FROM marked WHERE NOT shared OR side = 'chosen'
""")
def preference_pairs(spark, sf_dir):
    return preferences.format_pairs(*preferences.pairs_by_id(table(spark, sf_dir, "conversations")))


@query("op4_length_histogram")
def context_limits(spark, sf_dir):
    lengths = length_histogram.encoded_lengths(table(spark, sf_dir, "documents").select("text"), vocabulary())
    return length_histogram.suffix_sums(stored(length_histogram.histogram(lengths), "lengths"))


@query("op6_prefix_fingerprints")
def edited_fingerprints(spark, sf_dir):
    return fingerprints.against_next(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op7_page_differencing")
def page_texts(spark, sf_dir):
    return page_text.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


SHARDS = [f"shard-{i:03d}" for i in range(128)]


@query("op10_lookup_table_sharding")
def placed_documents(spark, sf_dir):
    """The shard of every document, and the one it would go to without the last shard."""
    tables = {"shard": sharding.lookup_table(spark, SHARDS), "shard_after_loss": sharding.lookup_table(spark, SHARDS[:-1])}
    return sharding.place(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", tables)


@query("op11_importance_resampling", r"""
WITH RECURSIVE texts AS (
  SELECT 'd' AS side, row_number() OVER () AS rid, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
  UNION ALL SELECT 'b', row_number() OVER (), translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark),
ids AS (SELECT row_number() OVER () AS rid, doc_id FROM documents),
words AS (SELECT side, rid, unnest(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM texts),
shifts AS (
  SELECT CAST(b AS BIGINT) AS b, CAST(b AS BIGINT) AS c, 0 AS k FROM range(256) bytes(b)
  UNION ALL SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM shifts WHERE k < 8),
lookup AS (SELECT list(c ORDER BY b) AS entries FROM shifts WHERE k = 8),
spelled AS (SELECT word, hex(encode(word)) AS h FROM (SELECT DISTINCT word FROM words)),
hashed AS (
  SELECT word, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(range(1, length(h), 2), lambda i: CAST('0x' || substr(h, i, 2) AS BIGINT))),
                               lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM spelled, lookup),
counts AS (
  SELECT bucket, CAST(count(*) FILTER (side = 'd') AS DOUBLE) AS s, CAST(count(*) FILTER (side = 'b') AS DOUBLE) AS t
  FROM words JOIN hashed USING (word) GROUP BY bucket),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1) * ((SELECT sum(s) FROM counts) + 10000) / ((s + 1) * ((SELECT sum(t) FROM counts) + 10000)))) AS BIGINT) AS gain
  FROM counts),
weights AS (
  SELECT rid, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS weight
  FROM words JOIN hashed USING (word) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY rid),
scores AS (
  SELECT rid, doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM ids LEFT JOIN weights USING (rid)),
ranks AS (
  SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS place, count(*) OVER () * 10 // 100 AS drawn
  FROM scores WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= drawn THEN place END AS rank FROM scores LEFT JOIN ranks USING (rid)
""")
def resampled_documents(spark, sf_dir):
    docs, target = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return importance.resample(docs, target, longest=1, buckets=10_000, least_words=20, share=(10, 100), seed=2024)


def quality_sql() -> str:
    stops = ", ".join(f"'{w}'" for w in quality_rules.STOP_WORDS)
    broken = []
    for _, above, below, least, most in quality_rules.RULES:
        broken += [f"100 * {above} < {n} * {below}" for n in (least,) if n is not None]
        broken += [f"100 * {above} > {n} * {below}" for n in (most,) if n is not None]
    return rf"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
words AS (
  SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(t, chr(10)), lambda line: regexp_matches(line, '[^\x20\x09-\x0D]')) AS lines
  FROM docs),
windows AS (SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM words, unnest(range(1, len(w) - 1)) AS places(i)),
again AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM windows) WHERE n > 1),
covered AS (SELECT rid, count(DISTINCT i + k) AS n FROM again, (VALUES (0), (1), (2)) AS steps(k) GROUP BY rid),
counted AS (
  SELECT doc_id, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(n, 0) AS n_repeat_words, len(lines) AS n_lines,
         len(list_filter(lines, lambda line: regexp_matches(line, '\p{{Lu}}') AND NOT regexp_matches(line, '\p{{Ll}}'))) AS n_shouted,
         len(list_filter(w, lambda x: lower(x) IN ({stops}))) AS n_stop_words
  FROM words LEFT JOIN covered USING (rid)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT (base_failed OR {" OR ".join(broken)}) AS kept FROM judged
"""


@query("op12_quality_rules", quality_sql())
def judged_documents(spark, sf_dir):
    judged = quality_rules.judged(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op13_filter_interaction_audit", r"""
WITH texts AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
firsts AS (SELECT t, min(doc_id) AS first FROM texts GROUP BY t),
flags AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
failures AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b,
         100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d, coalesce(doc_id > first, false) AS e
  FROM texts JOIN firsts USING (t) LEFT JOIN flags USING (doc_id)),
cells AS (
  SELECT part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS mask, count(*) AS docs,
         count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM failures GROUP BY part, mask),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
walks AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
spots AS (
  SELECT filter_order, CAST(s AS INTEGER) AS step, 1 << (ascii(substr(filter_order, s, 1)) - 65) AS bit, substr(filter_order, 1, s - 1) AS earlier
  FROM walks, range(1, 6) AS steps(s)),
steps AS (
  SELECT filter_order, step, bit,
         contains(earlier, 'A')::INT + 2 * contains(earlier, 'B')::INT + 4 * contains(earlier, 'C')::INT + 8 * contains(earlier, 'D')::INT + 16 * contains(earlier, 'E')::INT AS before
  FROM spots),
report AS (
  SELECT part, filter_order, step, bit,
         CAST(coalesce(sum(docs) FILTER (mask & (before | bit) = 0), 0) AS BIGINT) AS kept,
         CAST(coalesce(sum(docs) FILTER (mask & before = 0 AND mask & bit <> 0), 0) AS BIGINT) AS removed,
         CAST(coalesce(sum(docs) FILTER (mask & before <> 0 AND mask & bit <> 0), 0) AS BIGINT) AS redundant,
         CAST(coalesce(sum(docs) FILTER (mask = bit), 0) AS BIGINT) AS unique_fails,
         CAST(coalesce(sum(good) FILTER (mask & before = 0 AND mask & bit <> 0), 0) AS BIGINT) AS good_lost,
         CAST(coalesce(sum(toxic) FILTER (mask & before = 0 AND mask & bit <> 0), 0) AS BIGINT) AS toxic_lost
  FROM cells, steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM report
""")
def filter_interactions(spark, sf_dir):
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
