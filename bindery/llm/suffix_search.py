"""Benchmark decontamination by suffix arrays of the documents.

A task cuts its documents into shards of bounded size. The words of a shard form one sequence, with a separator after each
document, and the suffixes of that sequence are sorted by prefix doubling as deep as the longest benchmark item. Every
suffix of every item is then searched: each further word narrows its interval of the sorted suffixes by two binary
searches, for all suffixes of all items at once. The last interval that isn't empty holds the longest verbatim matches and
their places; the interval after a full window holds all places of the window. Nothing is shuffled.

Words are compared by 64-bit hashes, sorted by them as well. The benchmark is sent to the tasks in blocks of bounded size;
its size is checked, and a larger one takes more passes over the documents, which carry what was hit so far.

Nulls, empty texts and texts without words have no matches. A document is searched whole; it may be longer than a shard.
Repeated documents are each reported, items that are equal are each counted. With no items nothing is contaminated.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, LongType, StringType, StructField

from bindery.llm import common

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 10
SHARD_BYTES = 512 << 10
BLOCK_BYTES = 16 << 20  # benchmark text sent to the tasks at a time


class Words:
    """Cuts texts into words `[0-9a-z\\x80-]`, A-Z lower-cased, and hashes them."""

    def __init__(self) -> None:
        code = np.arange(256)
        lower = np.where((code >= 65) & (code <= 90), code + 32, code)
        self.inside = ((lower >= 48) & (lower <= 57)) | ((lower >= 97) & (lower <= 122)) | (lower >= 128)
        self.values = np.random.default_rng(20).integers(1, 2**63, 256, dtype=np.uint64)[lower]
        self.power = self.unpower = np.zeros(0, np.uint64)
        self.base, self.inverse = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))

    def __call__(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Hash, begin and end of each word, and how many words come before each text (one more at the end)."""
        n = len(data)
        inside = np.zeros(n + 2, bool)
        inside[1:-1] = self.inside[data]
        turns = np.flatnonzero(inside[1:] != inside[:-1])
        begin, end = turns[::2], turns[1::2]
        cuts = ends[1:-1]  # words that reach over the end of a text are split there
        cuts = np.unique(cuts[(cuts > 0) & (cuts < n)])
        cuts = cuts[inside[cuts] & inside[cuts + 1]]
        if len(cuts):
            begin, end = np.sort(np.append(begin, cuts)), np.sort(np.append(end, cuts))
        power, inverse = self.powers(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.values[data] * power[:n], out=sums[1:])
        hashes = (sums[end] - sums[begin]) * inverse[begin]
        # Mixed, so that low and high bits count alike. 0 is left to separators.
        hashes = (hashes ^ (hashes >> np.uint64(32))) * self.base
        hashes = np.maximum(hashes ^ (hashes >> np.uint64(29)), np.uint64(1))
        return hashes, begin, end, np.searchsorted(begin, ends)

    def powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """At least n powers of the base and of its inverse, modulo 2 ** 64."""
        if len(self.power) < n:
            grown = []
            for factor in (self.base, self.inverse):
                each = np.full(max(n, 1 << 20), factor, np.uint64)
                each[0] = 1
                grown.append(np.multiply.accumulate(each))
            self.power, self.unpower = grown
        return self.power, self.unpower


class Queries:
    """The suffixes of all items: word hashes in one sequence, and for each suffix its item, its words, its window."""

    def __init__(self, items: list[tuple[object, str | None]], window: int, words: Words) -> None:
        self.ids = ["" if i is None else str(i) for i, _ in items]
        self.words, _, _, starts = words(*common.utf8(pa.array([t for _, t in items], pa.string())))
        sizes = np.diff(starts)
        self.item = np.repeat(np.arange(len(items)), sizes)
        self.rest = np.repeat(starts[1:], sizes) - np.arange(len(self.words))
        self.window = np.repeat(np.minimum(sizes, window), sizes)
        self.longest = int(sizes.max(initial=1))


def suffix_array(ranks: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``ranks`` (0 .. 2 ** 31), sorted by at least ``depth`` of what follows them."""
    n = len(ranks)
    key = ranks.astype(np.int64) << 32
    key[:-1] |= ranks[1:]
    order = np.argsort(key)
    key = key[order]
    head = np.append(True, key[1:] != key[:-1])  # begins a group of equals
    place = np.empty(n + 1, np.int64)  # of a suffix: that of its group's head
    place[n] = -1
    place[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    known = 2
    while known < depth:
        tied = np.flatnonzero(~(head & np.append(head[1:], True)))
        if not len(tied):
            break
        suffixes = order[tied]
        key = place[suffixes] << 32 | (place[np.minimum(suffixes + known, n)] + 1)
        by = np.argsort(key)
        key, suffixes = key[by], suffixes[by]
        order[tied] = suffixes
        new = np.append(True, key[1:] != key[:-1])
        head[tied] = new
        place[suffixes] = tied[np.maximum.accumulate(np.where(new, np.arange(len(tied)), 0))]
        known *= 2
    return order


class Shard:
    """Documents as one word sequence with its suffix array."""

    def __init__(self, words: Words, data: np.ndarray, ends: np.ndarray, depth: int) -> None:
        hashes, _, _, starts = words(data, ends)
        self.sizes = np.diff(starts)
        docs = len(self.sizes)
        sequence = np.zeros(len(hashes) + docs + depth, np.uint64)
        sequence[np.arange(len(hashes)) + np.repeat(np.arange(docs), self.sizes)] = hashes
        self.starts = starts[:-1] + np.arange(docs)  # of each document in the sequence
        self.vocabulary, ranks = np.unique(sequence, return_inverse=True)
        self.ranks, self.depth = ranks.astype(np.int32), depth
        self.order = suffix_array(self.ranks, depth)
        self.first = np.append(0, np.cumsum(np.bincount(ranks, minlength=len(self.vocabulary))))

    def look_up(self, hashes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at, -1)

    def bound(self, low: np.ndarray, high: np.ndarray, depth: int, word: np.ndarray, after: bool) -> np.ndarray:
        """In each interval of the order, the first place whose word at ``depth`` is not below ``word``, or is above it."""
        low, high = low.copy(), high.copy()
        while (open_ := np.flatnonzero(low < high)).size:
            middle = (low[open_] + high[open_]) >> 1
            found = self.ranks[np.minimum(self.order[middle] + depth, len(self.ranks) - 1)]
            right = found <= word[open_] if after else found < word[open_]
            low[open_[right]] = middle[right] + 1
            high[open_[~right]] = middle[~right]
        return low

    def search(self, queries: Queries) -> dict[str, np.ndarray]:
        """For each suffix: length and interval of its longest matches, and interval of its full window (empty if none)."""
        words = self.look_up(queries.words)
        n = len(words)
        length, low, high = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
        window_low, window_high = np.zeros(n, np.int64), np.zeros(n, np.int64)
        live, depth = np.flatnonzero(words >= 0), 1
        a, b = self.first[words[live]], self.first[words[live] + 1]
        while live.size:
            length[live], low[live], high[live] = depth, a, b
            full = queries.window[live] == depth
            window_low[live[full]], window_high[live[full]] = a[full], b[full]
            longer = queries.rest[live] > depth
            live, a, b = live[longer], a[longer], b[longer]
            word = words[live + depth]
            left = self.bound(a, b, depth, word, False)
            right = self.bound(left, b, depth, word, True)
            keep = (left < right) & (word >= 0)
            live, a, b = live[keep], left[keep], right[keep]
            depth += 1
        return {"length": length, "low": low, "high": high, "window_low": window_low, "window_high": window_high}

    def places(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All positions in the intervals, and of which interval each is."""
        sizes = high - low
        which = np.repeat(np.arange(len(low)), sizes)
        return self.order[np.arange(len(which)) + np.repeat(low - np.cumsum(sizes) + sizes, sizes)], which

    def document(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, positions, "right") - 1


def hits(shard: Shard, queries: Queries) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hit flags of the sequence; pairs of document and item; for each document the words of its longest match."""
    found = shard.search(queries)
    with_window = np.flatnonzero(found["window_high"] > found["window_low"])
    at, which = shard.places(found["window_low"][with_window], found["window_high"][with_window])
    suffix = with_window[which]
    n = len(shard.ranks)
    change = np.bincount(at, minlength=n + 1) - np.bincount(at + queries.window[suffix], minlength=n + 1)
    docs = shard.document(at)
    pairs = np.unique(docs * max(len(queries.ids), 1) + queries.item[suffix])
    longest = np.zeros(len(shard.sizes), np.int64)
    words, length = shard.look_up(queries.words), queries.window[suffix].copy()
    going = np.arange(len(at))
    while going.size:
        more = length[going] < queries.rest[suffix[going]]
        going = going[more]
        step = length[going]
        going = going[shard.ranks[at[going] + step] == words[suffix[going] + step]]
        length[going] += 1
    np.maximum.at(longest, docs, length)
    return np.cumsum(change)[:n] > 0, pairs // max(len(queries.ids), 1), pairs % max(len(queries.ids), 1), longest


def blocks(benchmark: DataFrame, item: str, text: str, limit: int) -> Iterator[list[tuple[object, str | None]]]:
    """The benchmark's rows in blocks of at most ``limit`` bytes, or one value of the hash of item and text."""
    rows = benchmark.select(common.named(item).alias("item"), common.named(text).alias("text"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(64)
    total = rows.agg(F.sum(size)).first()[0] or 0
    count = max(1, -(-2 * total // limit)) if total > limit else 1
    part = F.pmod(F.xxhash64("item", "text"), F.lit(count))
    for k in range(count):
        yield [tuple(r) for r in rows.where(part == k).orderBy("item", "text").collect()]


def annotate(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW, limit: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with what the benchmark's windows hit.

    Adds ``n_words``, ``n_hit`` (words inside any window), ``n_items``, ``items_sha256`` (the ids as sorted strings),
    ``longest_match`` (words of the longest verbatim match that holds a window), ``contaminated``, and ``hit_bits``, one bit
    for each word. An item with fewer words than the window is one window.
    """
    state = [StructField("hit_bits", BinaryType()), StructField("hit_items", ArrayType(StringType())), StructField("longest_match", LongType())]
    frame, columns = docs, docs.columns
    # One pass for each block of the benchmark; the last also sums up, so a benchmark of one block takes one worker a task.
    passes = list(blocks(benchmark, item, item_text, limit))
    last = [
        StructField("n_words", LongType()), StructField("n_hit", LongType()), StructField("n_items", LongType()),
        StructField("items_sha256", StringType()), StructField("contaminated", BooleanType()),
    ]
    kept = [c for c in columns if c.lower() not in {f.name.lower() for f in state + last}]
    for k, rows in enumerate(passes):
        ends = k + 1 == len(passes)
        inputs = [text] if k == 0 else [text, *[f.name for f in state]]
        frame = common.add_columns(frame, inputs, state + last * ends, search_work(rows, window, ends), SHARD_BYTES)
    return frame.select(*[common.named(c) for c in kept], *[f.name for f in last], "longest_match", "hit_bits")


def search_work(rows: list[tuple[object, str | None]], window: int, ends: bool):
    """One pass over the documents: what a block of items hits, added to what earlier blocks hit, and if it ``ends`` the sums."""

    def work():
        words = Words()
        queries = Queries(rows, window, words)

        def run(columns):
            shard = Shard(words, *common.utf8(columns[0]), queries.longest)
            flags, docs, items, longest = hits(shard, queries)
            found: list[list[str]] = [[] for _ in shard.sizes]
            for d, i in zip(docs.tolist(), items.tolist()):
                found[d].append(queries.ids[i])
            bits = [np.packbits(flags[a : a + n]).tobytes() for a, n in zip(shard.starts.tolist(), shard.sizes.tolist())]
            if len(columns) > 1:
                bits = [(int.from_bytes(x) | int.from_bytes(y)).to_bytes(len(x)) for x, y in zip(bits, columns[1].to_pylist())]
                found = [x + y for x, y in zip(found, columns[2].to_pylist())]
                longest = np.maximum(longest, columns[3].to_numpy())
            out = [pa.array(bits, pa.binary()), pa.array(found, pa.list_(pa.string())), pa.array(longest, pa.int64())]
            return out + summary(shard.sizes, bits, found) if ends else out

        return run

    return work


def summary(sizes: np.ndarray, bits: list[bytes], items: list[list[str]]) -> list[pa.Array]:
    n_hit = [int.from_bytes(x).bit_count() for x in bits]
    digests = [hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() for x in items]
    return [
        pa.array(sizes, pa.int64()), pa.array(n_hit, pa.int64()), pa.array([len(x) for x in items], pa.int64()),
        pa.array(digests, pa.string()), pa.array([n > 0 for n in n_hit], pa.bool_()),
    ]


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` in which no window of the benchmark occurs, unchanged."""
    frame, (text,) = common.numbered(docs, options.get("text", "text"))
    marked = annotate(frame, benchmark, **options | {"text": text})
    return common.restored(marked.where(~F.col("contaminated")), docs)


def longest_matches(docs: DataFrame, benchmark: DataFrame, least: int = WINDOW, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """For each suffix of each item that matches ``least`` words or more somewhere: its longest verbatim match.

    Columns item_id (string), item_word, words, and one place: the smallest doc_id and in it the first doc_word.
    """
    schema = "item_id string, item_word long, words long, doc_id long, doc_word long"
    out = None
    for rows in blocks(benchmark, "item_id", "text", BLOCK_BYTES):

        def work(batches, rows=rows):
            words = Words()
            queries = Queries(rows, least, words)
            first = np.append(0, np.cumsum(np.bincount(queries.item, minlength=len(rows))))
            for batch in batches:
                for part in common.parts(batch, "text", SHARD_BYTES):
                    shard = Shard(words, *common.utf8(part.column("text")), queries.longest)
                    found = shard.search(queries)
                    good = np.flatnonzero(found["length"] >= least)
                    at, which = shard.places(found["low"][good], found["high"][good])
                    docs = shard.document(at)
                    ids = np.array([2**63 - 1 if x is None else x for x in part.column("doc_id").to_pylist()], np.int64)[docs]
                    by = np.lexsort((at - shard.starts[docs], ids, which))
                    best = by[np.append(True, which[by][1:] != which[by][:-1])] if len(by) else by
                    suffix = good[which[best]]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([queries.ids[i] for i in queries.item[suffix]], pa.string()), pa.array(suffix - first[queries.item[suffix]], pa.int64()),
                        pa.array(found["length"][suffix], pa.int64()), pa.array(ids[best], pa.int64()), pa.array((at - shard.starts[docs])[best], pa.int64()),
                    ], names=["item_id", "item_word", "words", "doc_id", "doc_word"])

        one = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(work, schema)
        out = one if out is None else out.unionAll(one)
    best = F.min(F.struct(-F.col("words"), "doc_id", "doc_word")).alias("best")
    return out.groupBy("item_id", "item_word").agg(best).select(
        "item_id", "item_word", (-F.col("best.col1")).alias("words"), "best.doc_id", "best.doc_word"
    )
