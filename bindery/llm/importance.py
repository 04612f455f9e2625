"""Importance resampling towards a target: documents are drawn by the likelihood ratio of their hashed words.

Words and runs of words are features; a feature's bucket is the CRC-32 of its bytes modulo the number of buckets. A CRC is
linear: it is the XOR of what each byte gives at its distance from the end, and of a constant for the length. So a table holds
the contribution of every byte at every distance below a block, and one ``bitwise_xor.reduceat`` over all feature spans of a
batch gives all their sums at once. Longer spans are cut into blocks from their end: each block is reduced likewise, and the
blocks are folded from the first to the last, four more tables moving a sum on by a block.

Texts are read once: a task keeps the bucket counts of its documents in one array and stores each document's buckets, two
bytes for each feature. The log ratios of the buckets are a small table that goes to the tasks, and a document's weight is the
sum over its stored buckets. Scores add noise from a hash of the id, so the highest ones are a draw without replacement that a
rerun repeats. Ranks come from a range partitioning of the scores near the top; no task sees all of them.

Null and empty texts have no feature and weight 0. Null ids are hashed as empty text and come last among equal scores. Rows
that repeat are documents of their own, with equal scores and ranks next to each other. Texts of any length are read whole.
Without documents the result is empty; without target texts all target counts are 0. Other columns are not read.
"""

from __future__ import annotations

import sys
import zlib

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bindery.llm import common
from bindery.operators.positions import numbered
from bindery.session import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKETS = 10_000
LEAST_WORDS = 20
DRAWN = (10, 100)  # of so many hundredths of the documents
SEED = 2024
BLOCK = 32  # bytes of a block; distances in the table
PART_BYTES = 2 << 20
ACCURACY = 10_000  # of the percentile that cuts off low scores


class PositionCrc:
    """CRC-32 of many spans of one byte array."""

    def __init__(self, block: int = BLOCK) -> None:
        zeros = [zlib.crc32(bytes(n)) for n in range(block + 1)]
        self.block = block
        # What a byte gives at a distance from the end: its CRC before so many zero bytes, less that of zero bytes alone.
        self.at = np.array([[zlib.crc32(bytes([b]) + bytes(d)) ^ zeros[d + 1] for b in range(256)] for d in range(block)], np.uint32)
        # What each byte of a sum becomes when a block follows.
        self.on = np.empty((4, 256), np.uint32)
        for i in range(4):
            for b in range(256):
                # A CRC register meets the next bytes by XOR, so a sum moves on like a text that begins with its bytes.
                word = (b << (8 * i)).to_bytes(4, "little") + bytes(block - 4)
                self.on[i, b] = zlib.crc32(word) ^ zeros[block]
        self.constants = np.array(zeros, np.uint32)

    def constant(self, lengths: np.ndarray) -> np.ndarray:
        """CRCs of zero bytes."""
        if len(lengths) and lengths.max() >= len(self.constants):
            more = list(self.constants)
            for _ in range(len(more), int(lengths.max()) + 1):
                more.append(zlib.crc32(b"\0", int(more[-1])))
            self.constants = np.array(more, np.uint32)
        return self.constants[lengths]

    def moved(self, sums: np.ndarray) -> np.ndarray:
        """Sums after one more block of zero bytes."""
        out = self.on[0][sums & 255]
        for i in (1, 2, 3):
            out = out ^ self.on[i][(sums >> np.uint32(8 * i)) & 255]
        return out

    def __call__(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The CRC of every span; none is empty, and they may overlap."""
        length = end - begin
        if not len(length):
            return np.zeros(0, np.uint32)
        # Blocks of a span are aligned to its end; the first may be short.
        blocks = -(-length // self.block)
        first = np.cumsum(blocks) - blocks
        span = np.repeat(np.arange(len(length)), blocks)
        after = blocks[span] - 1 - (np.arange(len(span)) - first[span])  # blocks that follow in the span
        stop = end[span] - after * self.block
        start = np.maximum(begin[span], stop - self.block)
        size = stop - start
        offset = np.cumsum(size) - size
        distance = np.repeat(size + offset, size) - 1 - np.arange(size.sum())
        given = self.at[distance, data[np.repeat(start - offset, size) + np.arange(size.sum())]]
        sums = np.bitwise_xor.reduceat(given, offset)
        out = sums[first]
        live = np.flatnonzero(blocks > 1)
        k = 1
        while len(live):
            out[live] = self.moved(out[live]) ^ sums[first[live] + k]
            k += 1
            live = live[blocks[live] > k]
        return out ^ self.constant(length)


class Features:
    """Buckets of the features of texts."""

    def __init__(self, longest: int, buckets: int) -> None:
        code = np.arange(256)
        self.inside = (code >= 128) | ((code >= 48) & (code <= 57)) | ((code >= 97) & (code <= 122))
        self.lower = np.where((code >= 65) & (code <= 90), code + 32, code).astype(np.uint8)
        self.longest, self.buckets, self.crc = longest, buckets, PositionCrc()

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words of each text, the buckets of all features in order of the texts, and where each text's begin and end."""
        data, ends = common.utf8(texts)
        data = self.lower[data]
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = self.inside[data]
        turns = np.flatnonzero(inside[1:] != inside[:-1])
        begin, end = turns[::2], turns[1::2]
        cuts = np.unique(ends[1:-1])
        cuts = cuts[inside[cuts] & inside[cuts + 1]]  # a word may not reach into the next text
        if len(cuts):
            begin, end = np.sort(np.append(begin, cuts)), np.sort(np.append(end, cuts))
        words = np.searchsorted(begin, ends)
        owner = np.repeat(np.arange(len(texts)), np.diff(words))
        found, owners = [self.crc(data, begin, end) % self.buckets], [owner]
        if self.longest > 1:
            data, begin, end = joined(data, begin, end)
            for n in range(2, self.longest + 1):
                same = owner[n - 1 :] == owner[: max(len(owner) - n + 1, 0)]
                found.append(self.crc(data, begin[: len(same)][same], end[n - 1 :][same]) % self.buckets)
                owners.append(owner[n - 1 :][same])
        owners = np.concatenate(owners)
        counts = np.bincount(owners, minlength=len(texts))
        buckets = np.concatenate(found)
        if self.longest > 1:
            buckets = buckets[np.argsort(owners, kind="stable")]
        return np.diff(words), buckets, np.append(0, np.cumsum(counts))


def joined(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words with one space between them, so that a run of words is a span."""
    size = end - begin + 1
    stop = np.cumsum(size) - 1
    out = np.full(size.sum(), 32, np.uint8)
    word = np.repeat(np.arange(len(size)), size - 1)
    place = np.arange(len(word)) - np.repeat(np.cumsum(size - 1) - (size - 1), size - 1)
    start = stop - size + 1
    out[start[word] + place] = data[begin[word] + place]
    return out, start, stop


def read_features(texts: DataFrame, text: str, keys: list[str], longest: int, buckets: int) -> DataFrame:
    """A row for each text (kind 0: its id, words, features, packed buckets), and bucket counts of each task (kind 1: counts)."""
    names = ["kind", "doc_id", "n_words", "n_features", "buckets"]
    wide = np.uint16 if buckets <= 1 << 16 else np.uint32

    def work(batches):
        features, totals = Features(longest, buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for part in common.parts(batch, "text", PART_BYTES):
                words, found, ends = features(part.column("text"))
                totals += np.bincount(found, minlength=buckets)
                if keys:
                    packed = found.astype(wide)
                    contents = [packed[a:b].tobytes() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
                    columns = [pa.array(np.zeros(len(words), np.int32)), part.column("doc_id"), pa.array(words), pa.array(np.diff(ends)), pa.array(contents, pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, names=names)
        one = [pa.array([1], pa.int32()), pa.array([None], id_type), pa.array([0]), pa.array([0]), pa.array([totals.tobytes()], pa.binary())]
        yield pa.RecordBatch.from_arrays(one, names=names)

    doc = F.col(f"`{keys[0]}`").cast("long") if keys else F.lit(None).cast("long")
    id_type = pa.int64()
    chosen = texts.select(doc.alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    return chosen.mapInArrow(work, "kind int, doc_id long, n_words long, n_features long, buckets binary")


def bucket_counts(features: DataFrame, buckets: int) -> np.ndarray:
    """Features of all texts in each bucket. Tasks add up what they read, so the driver gets one number for each bucket."""

    def work(batches):
        totals = np.zeros(buckets, np.int64)
        for batch in batches:
            for content in batch.column(0):
                totals += np.frombuffer(content.as_buffer(), np.int64)
        at = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(totals[at], pa.int64())], names=["bucket", "n"])

    rows = features.where("kind = 1").select("buckets").mapInArrow(work, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[rows.column(0).to_numpy()] = rows.column(1).to_numpy()
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What a feature of each bucket adds to a weight: the log ratio of smoothed shares, in thousandths, rounded down."""
    s, t, k = source.astype(float), target.astype(float), len(source)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + k) / ((s + 1) * (t.sum() + k)))).astype(np.int64)


def weights(features: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of the stored texts."""
    wide = np.uint16 if len(gain) <= 1 << 16 else np.uint32

    def work(batches):
        for batch in batches:
            sums = [int(gain[np.frombuffer(c.as_buffer(), wide)].sum()) for c in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sums, pa.int64())], names=["doc_id", "n_words", "n_features", "weight"])

    chosen = features.where("kind = 0").select("doc_id", "n_words", "n_features", "buckets")
    return chosen.mapInArrow(work, "doc_id long, n_words long, n_features long, weight long")


def scored(weighted: DataFrame, seed: int = SEED) -> DataFrame:
    """Adds ``score``: the weight and noise that depends on the id alone."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")
    return weighted.withColumn("score", F.col("weight") + noise)


def ranked(rows: DataFrame, eligible: str, share: tuple[int, int] = DRAWN) -> DataFrame:
    """``rows`` with ``rank`` for the drawn ones: the given share of the eligible, highest scores first, then smaller ids."""
    percent, whole = share
    above = 1 - percent / whole - 10 / ACCURACY  # the percentile errs by 1 / ACCURACY of the rows at most
    found = rows.where(eligible).agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("score", F.lit(max(above, 0.0)), ACCURACY).alias("cut")).first()
    drawn = percent * found["n"] // whole
    out = rows.columns
    none = F.lit(None).cast("long").alias("rank")
    if not drawn:
        return rows.select(*out, none)
    near = F.expr(eligible) & (F.col("score") >= F.lit(found["cut"]))
    order = {"_falling": -F.col("score"), "_last": F.col("doc_id").isNull()}
    placed = numbered(rows.where(near).withColumns(order), ["_falling", "_last", "doc_id"], into="rank")
    placed = placed.select(*out, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank"))
    return placed.unionAll(rows.where(~near).select(*out, none))


def resample(
    docs: DataFrame, target: DataFrame, doc: str = "doc_id", text: str = "text", target_text: str = "text", longest: int = 1,
    buckets: int = BUCKETS, least_words: int = LEAST_WORDS, share: tuple[int, int] = DRAWN, seed: int = SEED,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document; only drawn ones have a rank."""
    read = stored(read_features(docs, text, [doc], longest, buckets), "features")
    source = bucket_counts(read, buckets)
    wanted = bucket_counts(read_features(target, target_text, [], longest, buckets), buckets)
    rows = stored(scored(weights(read, gains(source, wanted)), seed), "scores")
    return ranked(rows, f"n_words >= {int(least_words)}", share).drop("n_words")
