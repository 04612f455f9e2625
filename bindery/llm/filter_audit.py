"""Audit of filters that act one after another: what each removes in every order, from one pass over the documents.

A document's failures are a mask with one bit for each filter. Only the number of documents of each part and mask matters, a
few cells for each part. A Gray code then walks over all subsets of the filters and toggles one filter at a time: each cell
counts how many of the active filters it fails, and the running survivors change by the cells whose counter leaves or reaches
zero. The survivors of every subset are stored, 32 states for five filters, and each step of each order is a difference of two.

``audit`` has the five filters of the report on web text; ``mask_cells`` and ``orders`` take any filters, seven at most, since
the report has one row for each order and step.

Null texts are empty, null parts are the empty string; a document without id is a copy of nothing, is nothing's original and
has no label. Rows that repeat count each; rows with the same id and text are not copies of each other. A label counts if any
row of its id has it. Very long texts are read whole, once. An empty table gives an empty result. Other columns of the
documents are not read, whatever their names.
"""

from __future__ import annotations

import math
import sys
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bindery.session import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MOST_FILTERS = 7
PARTS_AT_ONCE = 64  # parts whose report is made at a time
SPACE = r"[\x20\x09-\x0D]+"
SCHEMA = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)


def text_failures(text: Column) -> dict[str, Column]:
    """Failure conditions that a text decides alone."""
    words = F.array_remove(F.split(text, SPACE), "")
    return {
        "A": F.size(words) < 200,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * 50,
        "C": F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long") * 100 > F.length(text).cast("long") * 3,
        "D": text.rlike(r"[#$%&*|]"),
    }


def failure_mask(failures: list[Column]) -> Column:
    """Bit i is set where condition i holds."""
    mask = F.lit(0)
    for i, fails in enumerate(failures):
        mask = mask + F.coalesce(fails, F.lit(False)).cast("int") * (1 << i)
    return mask


def later_copies(rows: DataFrame) -> DataFrame:
    """``rows`` (doc_id, digest, ...) with ``copied``: whether a row with a smaller id has the same digest.

    A digest that many rows have is one row of the other side, which is stored: it is broadcast where it is small, else the
    join is split where it is skewed.
    """
    ids = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    firsts = stored(ids.where("first < last").select("digest", "first"), "firsts")
    return rows.join(firsts, "digest", "left").withColumn("copied", F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))).drop("first")


def label_flags(labels: DataFrame) -> DataFrame:
    """(doc_id, good, toxic), one row for each id that has either."""
    good, toxic = F.bool_or(F.col("quality") == 1), F.bool_or(F.col("toxic") == 1)
    flags = labels.select("doc_id", "quality", "toxic").where("doc_id IS NOT NULL").groupBy("doc_id").agg(good.alias("good"), toxic.alias("toxic"))
    return stored(flags.where("good OR toxic"), "flags")


def mask_cells(rows: DataFrame, part: Column, mask: Column, good: Column, toxic: Column) -> DataFrame:
    """(part, mask, docs, good, toxic) for every part and mask that occurs. Tasks send one row for each."""
    rows = rows.select(part.alias("part"), mask.cast("int").alias("mask"), good.alias("good"), toxic.alias("toxic"))
    return rows.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("docs"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))


def survivors(counts: np.ndarray) -> np.ndarray:
    """Of ``counts`` by (part, mask, measure), what each subset of active filters leaves: by (part, subset, measure)."""
    masks = np.arange(counts.shape[1])
    failed = np.zeros(len(masks), np.int64)  # active filters that a cell fails
    alive = counts.sum(axis=1)
    states = np.empty_like(counts)
    states[:, 0] = alive
    for i in range(1, len(masks)):
        toggled = i & -i
        active = i ^ (i >> 1)
        touched = masks[masks & toggled != 0]
        if active & toggled:
            failed[touched] += 1
            alive = alive - counts[:, touched[failed[touched] == 1]].sum(axis=1)
        else:
            failed[touched] -= 1
            alive = alive + counts[:, touched[failed[touched] == 0]].sum(axis=1)
        states[:, active] = alive
    return states


def orders(cells: DataFrame, names: str) -> DataFrame:
    """One row for each part, order of the filters and step, from the ``mask_cells``; filter i is bit i and has letter i."""
    k = len(names)
    if not 0 < k <= MOST_FILTERS:
        raise ValueError(f"from one to {MOST_FILTERS} filters")
    walks = list(permutations(range(k)))
    # Of every order and step: the filter, and the subsets active before and after it.
    letter = np.array(walks).ravel()
    after = np.cumsum(1 << np.array(walks), axis=1)
    before = (after - (1 << np.array(walks))).ravel()
    after = after.ravel()
    spelled = np.repeat(["".join(names[i] for i in w) for w in walks], k)
    steps = np.tile(np.arange(1, k + 1, dtype=np.int32), math.factorial(k))
    full, bit = (1 << k) - 1, 1 << letter

    def report(parts: list[str], entries: list[list[dict]]) -> pa.RecordBatch:
        counts = np.zeros((len(parts), 1 << k, 3), np.int64)
        for i, cells_of in enumerate(entries):
            for c in cells_of:
                counts[i, c["mask"]] += (c["docs"], c["good"], c["toxic"])
        states = survivors(counts)
        lost = states[:, before] - states[:, after]
        removed = lost[:, :, 0]
        total = np.zeros((len(parts), k), np.int64)
        for i in range(k):
            total[:, i] = removed[:, letter == i].sum(axis=1)
        columns = [
            states[:, after, 0], removed, states[:, [0], 0] - states[:, bit, 0] - removed, states[:, full ^ bit, 0] - states[:, [full], 0],
            lost[:, :, 1], lost[:, :, 2], total[:, letter],
        ]
        given = [pa.array(np.repeat(np.array(parts, object), len(steps)), pa.string()), pa.array(np.tile(spelled, len(parts)), pa.string()), pa.array(np.tile(steps, len(parts)))]
        return pa.RecordBatch.from_arrays([*given, *[pa.array(c.ravel()) for c in columns]], names=[c.split()[0] for c in SCHEMA.split(", ")])

    def work(batches):
        for batch in batches:
            for at in range(0, len(batch), PARTS_AT_ONCE):
                some = batch.slice(at, PARTS_AT_ONCE)
                yield report(some.column(0).to_pylist(), some.column(1).to_pylist())

    # At most one cell for each mask, so the list of a part is short.
    by_part = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "docs", "good", "toxic")).alias("cells"))
    return by_part.mapInArrow(work, SCHEMA)


def audit(docs: DataFrame, labels: DataFrame, doc: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """The report of five filters: few words, few distinct words, capitals, symbols, later copies.

    Texts are read once, into rows of id, part, mask and digest, which are stored and joined with the ids of originals and
    with the labels.
    """
    name = lambda c: F.col(f"`{c}`")
    rows = docs.select(name(doc).alias("doc_id"), F.coalesce(name(part).cast("string"), F.lit("")).alias("part"), F.coalesce(name(text), F.lit("")).alias("text"))
    failures = text_failures(F.col("text"))
    rows = stored(rows.select("doc_id", "part", failure_mask(list(failures.values())).alias("mask"), F.unhex(F.sha2("text", 256)).alias("digest")), "masks")
    marked = later_copies(rows).join(label_flags(labels), "doc_id", "left")
    mask = F.col("mask") + F.col("copied").cast("int") * (1 << len(failures))
    has = lambda c: F.coalesce(F.col(c), F.lit(False))
    return orders(mask_cells(marked, F.col("part"), mask, has("good"), has("toxic")), "".join(failures) + "E")
