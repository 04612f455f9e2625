"""Join of documents by the Jaccard similarity of their word shingles, with adaptive multi-match prefixes.

Two sets that are similar enough share a token among the first few of each, in any order common to all; among some more
they share several. A document's prefix is lengthened as long as that is expected to pay: the frequencies of its tokens
bound how many documents share k of them by their sum over k, so longer prefixes read more postings and verify fewer pairs.
A pair must share correspondingly many prefix tokens before it is verified on whole sets: what it needs in all, less what
can lie behind the longer rest of the two.

Order: tokens that are rare come first, by hash; frequent ones follow by frequency. Frequencies are counted over all
documents within chunks of a task, tokens met once in a chunk left out, which changes the order and never the result. The
number of frequent tokens that tasks are told is bounded.

Equal sets are one node, known by a 64-bit digest. Postings and sets are sent with 48 bits of each token's hash. Groups of many similar nodes are not expanded into all pairs: each
token's nodes are first compared with one of them, links are joined to components, and only pairs that lie in different
components and share enough tokens are verified then. Components come out exact; links inside them aren't all listed.

Null and empty texts, and texts without words, have an empty set and are linked with nothing. Texts are read whole. Rows
that repeat are linked with each other, as their sets are equal. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField

from bindery.llm import common
from bindery.session import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE = 5
PERCENT = 75  # least similarity
FREQUENT = 1 << 20  # frequent tokens that tasks are told, at most
CHUNK_TOKENS = 1 << 21  # tokens a task counts at a time
PACKED_TOKENS = 1 << 19  # postings a task packs at a time
PART_BYTES = 1 << 18  # text bytes cut into shingles at a time; some arrays have eight bytes for each
BUCKET_TOKENS = 1 << 19  # tokens of all documents for each bucket of postings
PARTITION_BUCKETS = 16  # buckets a task reads, about
HOT = 1 << 16  # nodes that share a token above which its postings are spread
MULTIPLES = np.array([1, 2, 3, 4, 6, 8, 12, 16])
VERIFY_COST = 40  # of a pair, in postings read
FILTER_BITS = 1 << 28  # of a filter on nodes, at most
BATCH_ROWS = 1000  # texts or pairs of sets that a task is handed at a time


class Shingler:
    """Sets of shingle hashes of texts."""

    BASE = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, size: int = SHINGLE) -> None:
        code = np.arange(256)
        self.inside = ~((code == 32) | ((code >= 9) & (code <= 13)))
        lower = np.where((code >= 65) & (code <= 90), code + 32, code)
        self.values = np.random.default_rng(9).integers(1, 2**63, 256, dtype=np.uint64)[lower]
        self.base, self.inverse = self.BASE, np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
        self.power = self.unpower = np.zeros(0, np.uint64)
        self.size = size

    def mixed(self, x: np.ndarray) -> np.ndarray:
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))

    def words(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words, and how many come before each text."""
        n = len(data)
        if len(self.power) <= n:
            grown = []
            for factor in (self.base, self.inverse):
                each = np.full(n + 1 + PART_BYTES, factor, np.uint64)
                each[0] = 1
                grown.append(np.multiply.accumulate(each))
            self.power, self.unpower = grown
        inside = np.zeros(n + 2, bool)
        inside[1:-1] = self.inside[data]
        turns = np.flatnonzero(inside[1:] != inside[:-1])
        begin, end = turns[::2], turns[1::2]
        cuts = np.unique(ends[1:-1])
        cuts = cuts[inside[cuts] & inside[cuts + 1]]  # a word may not reach into the next text
        if len(cuts):
            begin, end = np.sort(np.append(begin, cuts)), np.sort(np.append(end, cuts))
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.values[data] * self.power[:n], out=sums[1:])
        return self.mixed((sums[end] - sums[begin]) * self.unpower[begin]), np.searchsorted(begin, ends)

    def sets(self, texts: pa.Array) -> list[np.ndarray]:
        """The distinct shingles of each text, sorted."""
        words, starts = self.words(*common.utf8(texts))
        k, m = self.size, len(words)
        rolled = np.zeros(max(m - k + 1, 0), np.uint64)
        for i in range(k):
            rolled = rolled * self.base + words[i : i + len(rolled)]
        rolled = self.mixed(rolled)
        out = []
        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
            if b - a >= k:
                out.append(np.unique(rolled[a : b - k + 1]))
            elif b > a:
                whole = np.uint64(b - a)
                for w in words[a:b]:
                    whole = self.mixed(np.array([whole * self.base + w], np.uint64))[0]
                out.append(np.array([whole], np.uint64))
            else:
                out.append(np.zeros(0, np.uint64))
        return out

    def node(self, tokens: np.ndarray) -> int:
        """Digest of a set."""
        total = np.add.reduce(self.mixed(tokens ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64) * self.base
        return int(self.mixed(np.array([total ^ np.bitwise_xor.reduce(tokens) ^ np.uint64(len(tokens))], np.uint64)).view(np.int64)[0])


def narrow(tokens: np.ndarray) -> bytes:
    """The upper 48 bits of each token."""
    return np.ascontiguousarray(tokens).astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()


def widened(content) -> np.ndarray:
    raw = np.frombuffer(content, np.uint8).reshape(-1, 6)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, 2:] = raw
    return out.view("<u8").ravel().astype(np.uint64)


def needed(n_a, rest_a, n_b, rest_b, percent: int) -> np.ndarray:
    """Prefix tokens that two sets of these sizes, with these numbers of tokens behind their prefixes, must share to be similar.

    Of the tokens that they share, those up to the end of the prefix that ends first are in both prefixes.
    """
    overlap = -(-percent * (n_a + n_b) // (100 + percent))
    return np.maximum(overlap - np.maximum(rest_a, rest_b), 1)


def least(n: np.ndarray | int, percent: int):
    """Tokens that a set of n shares at least with any set similar enough: percent of n, rounded up."""
    return -(-n * percent // 100)


def survey(docs: DataFrame, doc: str, text: str, size: int) -> DataFrame:
    """One row for each document (kind 0: doc_id, node, n), and counts of tokens met again within a chunk (kind 1: token, count)."""
    schema = "kind int, a long, b long, n long"

    def work(batches):
        with np.errstate(over="ignore"):
            shingler, seen, held, tokens = Shingler(size), set(), 0, np.empty(CHUNK_TOKENS, np.uint64)

            def counts():
                found = tokens[:held]
                found.sort()
                begin = np.flatnonzero(np.append(True, found[1:] != found[:-1]))
                count = np.diff(np.append(begin, held))
                again = count > 1
                return rows(1, found[begin[again]].view(np.int64), count[again], np.zeros(again.sum(), np.int64))

            def rows(kind, a, b, n):
                return pa.RecordBatch.from_arrays([pa.array(np.full(len(b), kind), pa.int32()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64())], names=["kind", "a", "b", "n"])

            for batch in batches:
                for part in common.parts(batch, "text", PART_BYTES):
                    sets = shingler.sets(part.column("text"))
                    nodes = [shingler.node(s) for s in sets]
                    yield rows(0, part.column("doc_id"), nodes, [len(s) for s in sets])
                    for node, s in zip(nodes, sets):
                        if node in seen or len(s) < 2:
                            continue
                        if held and held + len(s) > len(tokens):
                            yield counts()
                            held, seen = 0, set()
                        if len(s) > len(tokens):
                            tokens = np.empty(len(s), np.uint64)
                        seen.add(node)
                        tokens[held : held + len(s)] = s
                        held += len(s)
            if held:
                yield counts()
            del tokens
        common.released()

    return docs.select(common.named(doc).cast("long").alias("doc_id"), common.named(text).alias("text")).mapInArrow(work, schema)


def frequent_tokens(surveyed: DataFrame, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """At most ``limit`` tokens with their counts, sorted by token: those above the least power of two that leaves so few."""
    counts = surveyed.where("kind = 1").groupBy(F.col("a").alias("token")).agg(F.sum("b").alias("count"))
    bins = {r[0]: r[1] for r in counts.groupBy(F.floor(F.log2("count")).alias("bin")).count().collect()}
    at, kept = 64, 0
    while at > 1 and kept + bins.get(at - 1, 0) <= limit:
        at -= 1
        kept += bins.get(at, 0)
    table = counts.where(F.col("count") >= F.lit(1 << min(at, 62))).toArrow()
    token, count = table.column(0).to_numpy().view(np.uint64), table.column(1).to_numpy()
    by = np.argsort(token)
    return token[by], count[by]


def prefix(tokens: np.ndarray, frequent: tuple[np.ndarray, np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The prefix of a set, and the counts of its tokens, 1 for those that aren't frequent."""
    known, counts = frequent
    n = len(tokens)
    first = n - least(n, percent) + 1
    count = np.ones(n, np.int64)
    if len(known):
        at = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
        count = np.where(known[at] == tokens, counts[at], 1)
    order = np.argsort(count, kind="stable")  # tokens are sorted by hash
    count = count[order]
    sizes = first - 1 + MULTIPLES
    sizes = sizes[sizes <= n]
    read = np.cumsum(count - 1)[sizes - 1]
    multiples = MULTIPLES[: len(sizes)]
    best = int(np.argmin(read + VERIFY_COST * read / multiples))
    return tokens[order[: sizes[best]]], count[: sizes[best]]


def postings(docs: DataFrame, text: str, frequent, buckets: int, size: int, percent: int) -> DataFrame:
    """Postings of all prefixes, packed by bucket of their token: (bucket, content).

    ``content`` holds arrays: nodes, sizes, tokens behind the prefix, tokens (hot ones last), the place of each token's node.
    A node that several documents of a task's chunk have comes once.
    """

    def packed(token, owner, spread, nodes, sizes, rests):
        mixed = Shingler().mixed
        t, o, s = np.concatenate(token), np.concatenate(owner), np.concatenate(spread)
        nodes, sizes, rests = np.array(nodes, np.int64), np.array(sizes, np.int32), np.array(rests, np.int32)
        hot = s > HOT
        at, salt = np.flatnonzero(hot), np.zeros(len(t), np.uint64)
        salt[at] = nodes[o[at]].view(np.uint64) % (s[at] // HOT + 1).astype(np.uint64)
        key = (mixed(t + salt * Shingler.BASE) % np.uint64(buckets)).astype(np.int64) * 2 + hot
        by = np.argsort(key, kind="stable")
        t, o, hot, bucket = t[by], o[by], hot[by], key[by] >> 1
        cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        contents = []
        for a, b in zip(cuts, np.append(cuts[1:], len(t))):
            used, place = np.unique(o[a:b], return_inverse=True)
            head = np.array([b - a, len(used), hot[a:b].sum()], np.int64)
            place = place.astype(np.uint16 if len(used) <= 1 << 16 else np.uint32)
            arrays = (head, nodes[used], sizes[used], rests[used])
            contents.append(b"".join([*(x.tobytes() for x in arrays), narrow(t[a:b]), place.tobytes()]))
        return pa.RecordBatch.from_arrays([pa.array(bucket[cuts], pa.int64()), pa.array(contents, pa.binary())], names=["bucket", "content"])

    def work(batches):
        with np.errstate(over="ignore"):
            shingler, seen = Shingler(size), set()
            token, owner, spread, nodes, sizes, rests = [], [], [], [], [], []
            held = 0
            for batch in batches:
                for part in common.parts(batch, "text", PART_BYTES):
                    for s in shingler.sets(part.column("text")):
                        if len(s) < 2:
                            continue  # a set of one token is similar to its equal only
                        node = shingler.node(s)
                        if node in seen:
                            continue
                        seen.add(node)
                        tokens, count = prefix(s, frequent, percent)
                        token.append(tokens)
                        owner.append(np.full(len(tokens), len(nodes), np.int32))
                        spread.append(count)
                        nodes.append(node)
                        sizes.append(len(s))
                        rests.append(len(s) - len(tokens))
                        held += len(tokens)
                    if held > PACKED_TOKENS:
                        yield packed(token, owner, spread, nodes, sizes, rests)
                        token, owner, spread, nodes, sizes, rests, held, seen = [], [], [], [], [], [], 0, set()
            if token:
                yield packed(token, owner, spread, nodes, sizes, rests)
        del token, owner, spread
        common.released()

    return docs.select(common.named(text).alias("text")).mapInArrow(work, "bucket long, content binary")


def unpacked(content: bytes) -> tuple[np.ndarray, ...]:
    """Of each posting: token, node, size, tokens behind the prefix, whether the token is hot."""
    n, m, hot = np.frombuffer(content, np.int64, 3).tolist()
    at, out = 24, []
    for kind in (np.int64, np.int32, np.int32):
        out.append(np.frombuffer(content, kind, m, at))
        at += out[-1].nbytes
    token = widened(content[at : at + 6 * n])
    place = np.frombuffer(content, np.uint16 if m <= 1 << 16 else np.uint32, n, at + 6 * n).astype(np.int64)
    return token, out[0][place], out[1][place].astype(np.int64), out[2][place].astype(np.int64), np.arange(n) >= n - hot


def shared_tokens(packed: DataFrame, partitions: int, percent: int) -> DataFrame:
    """What nodes share, bucket by bucket. Buckets are sorted within a task, which so holds one at a time.

    kind 0: a and b are the only nodes with some tokens, n of them; x: how many tokens they must share. kind 1: the token a of
    three or more nodes has node b; x: the node's size, y: its tokens behind the prefix.
    """
    schema = "kind int, a long, b long, n long, x long, y long"

    def rows(kind, *columns):
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(columns[0]), kind), pa.int32()), *[pa.array(c, pa.int64()) for c in columns]], names=["kind", "a", "b", "n", "x", "y"])

    def of_bucket(contents):
        token, node, size, rest, hot = (np.concatenate(x) for x in zip(*contents))
        by = np.lexsort((node, token))
        token, node, size, rest, hot = token[by], node[by], size[by], rest[by], hot[by]
        new = np.append(True, (token[1:] != token[:-1]) | (node[1:] != node[:-1]))  # the same node from several tasks
        token, node, size, rest, hot = token[new], node[new], size[new], rest[new], hot[new]
        begin = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
        count = np.diff(np.append(begin, len(token)))
        many = np.repeat(count > 2, count) | hot
        two = begin[(count == 2) & ~hot[begin]]
        a, b = two, two + 1
        fits = np.minimum(size[a], size[b]) * 100 >= percent * np.maximum(size[a], size[b])
        a, b = a[fits], b[fits]
        need = needed(size[a], rest[a], size[b], rest[b], percent)
        a, b = node[a], node[b]
        order = np.lexsort((b, a))
        a, b, need = a[order], b[order], need[order]
        at = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))) if len(a) else np.zeros(0, np.int64)
        if len(at):
            yield rows(0, a[at], b[at], np.diff(np.append(at, len(a))), need[at], need[at])
        if many.any():
            yield rows(1, token[many].view(np.int64), node[many], np.ones(many.sum(), np.int64), size[many], rest[many])

    def work(batches):
        last, contents = None, []
        for batch in batches:
            for bucket, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                if bucket != last and contents:
                    yield from of_bucket(contents)
                    contents = []
                last = bucket
                contents.append(unpacked(bytes(content.as_buffer())))
        if contents:
            yield from of_bucket(contents)
        del contents
        common.released()

    return packed.repartition(partitions, "bucket").sortWithinPartitions("bucket").mapInArrow(work, schema)


def key_of(node: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Filter key of a node that a document has."""
    mixed = Shingler().mixed
    return mixed(node.view(np.uint64) ^ mixed(doc.view(np.uint64) + np.uint64(7)))


def longs(column: pa.Array) -> np.ndarray:
    return column.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)


def node_filter(nodes: DataFrame) -> tuple[np.ndarray, int]:
    """A Bloom filter of (node, doc_id) with three probes: it never misses one. Its size is bounded; when full it lets more pass."""
    count = nodes.count()
    bits = 1 << min(FILTER_BITS.bit_length() - 1, max(10, math.ceil(math.log2(16 * count + 1))))

    def work(batches):
        held = np.zeros(bits >> 3, np.uint8)
        with np.errstate(over="ignore"):
            for batch in batches:
                for p in probes(key_of(longs(batch.column(0)), longs(batch.column(1))), bits):
                    np.bitwise_or.at(held, p >> 3, (1 << (p & 7)).astype(np.uint8))
        at = np.flatnonzero(held)
        for a in range(0, len(at), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(at[a : a + (1 << 16)], pa.int64()), pa.array(held[at[a : a + (1 << 16)]].astype(np.int32))], names=["at", "bits"])

    table = nodes.mapInArrow(work, "at long, bits int").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    held = np.zeros(bits >> 3, np.uint8)
    held[table.column(0).to_numpy()] = table.column(1).to_numpy()
    return held, bits


def probes(key: np.ndarray, bits: int) -> list[np.ndarray]:
    return [((key >> np.uint64(s)) & np.uint64(bits - 1)).astype(np.int64) for s in (0, 13, 31)]


def passes(key: np.ndarray, held: np.ndarray, bits: int) -> np.ndarray:
    out = np.ones(len(key), bool)
    for p in probes(key, bits):
        out &= (held[p >> 3] >> (p & 7)) & 1 == 1
    return out


def sets_of(docs: DataFrame, doc: str, text: str, nodes: DataFrame, size: int) -> DataFrame:
    """(node, tokens) for at least the given (node, doc_id), from that document; rarely a node comes twice."""
    held, bits = node_filter(nodes)

    def work(batches):
        with np.errstate(over="ignore"):
            shingler, seen = Shingler(size), set()
            for batch in batches:
                for part in common.parts(batch, "text", PART_BYTES):
                    sets = shingler.sets(part.column("text"))
                    found = np.array([shingler.node(s) for s in sets], np.int64)
                    fresh = []
                    for i in np.flatnonzero(passes(key_of(found, longs(part.column("doc_id"))), held, bits)).tolist():
                        if len(sets[i]) > 1 and found[i] not in seen:
                            seen.add(found[i])
                            fresh.append(i)
                    yield pa.RecordBatch.from_arrays([pa.array(found[fresh], pa.int64()), pa.array([narrow(sets[i]) for i in fresh], pa.binary())], names=["node", "tokens"])
        common.released()

    return docs.select(common.named(doc).cast("long").alias("doc_id"), common.named(text).alias("text")).mapInArrow(work, "node long, tokens binary")


def verified(pairs: DataFrame, first: DataFrame, docs: DataFrame, doc: str, text: str, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough. ``first``: (node, doc_id), one document for each node."""
    pairs = stored(pairs.select("a", "b"), "pairs")
    sets = {x: sets_of(docs, doc, text, first.join(pairs.select(F.col(x).alias("node")).distinct(), "node", "left_semi"), size) for x in "ab"}
    joined = pairs.join(sets["b"].toDF("b", "tokens_b"), "b").join(sets["a"].toDF("a", "tokens_a"), "a").select("a", "b", "tokens_a", "tokens_b")

    def work(batches):
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = widened(x.as_buffer()), widened(y.as_buffer())
                both = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            good = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(good), batch.column(1).filter(good)], names=["a", "b"])
        common.released()

    return stored(joined.mapInArrow(work, "a long, b long"), "links")


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links``; the component is named by its smallest node.

    Every node takes the smallest name among its neighbours, then the name that this one has. The rounds needed grow with
    the logarithm of the longest path.
    """
    both = stored(links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    names = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("component")), "names")
    while True:
        near = both.join(names.toDF("b", "near"), "b").groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        taken = stored(names.join(near, "node").select("node", "component", F.least("component", "near").alias("taken")), "names")
        jump = taken.select(F.col("node").alias("taken"), F.col("taken").alias("further"))
        new = stored(taken.join(jump, "taken").select("node", F.least("taken", "further").alias("component"), (F.least("taken", "further") != F.col("component")).alias("changed")), "names")
        names = new.select("node", "component")
        if new.where("changed").isEmpty():
            return names


def similar_sizes(a: str, b: str, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def need_of(size_a: str, rest_a: str, size_b: str, rest_b: str, percent: int) -> Column:
    """``needed`` as a column."""
    total = (F.col(size_a) + F.col(size_b)) * percent
    overlap = F.expr(f"({size_a} + {size_b}) * {percent} div {100 + percent}") + F.when(total % (100 + percent) > 0, 1).otherwise(0)
    return F.greatest(overlap - F.greatest(rest_a, rest_b), F.lit(1).cast("long"))


def across_components(nodes: DataFrame, percent: int) -> DataFrame:
    """(a, b, n, need) for the pairs of nodes of different components that may share ``need`` of their tokens; n is 0.

    ``nodes``: (node, component, size, rest, tokens), the tokens of all in one order, rare ones first. A pair comes up at the
    first token that it shares, and there at least ``need`` tokens must be left to both. A node is dropped at a token where
    too few are left to it for every partner of similar size, and a token's largest component isn't paired with itself.
    """
    width = max(math.log(100 / percent), 1e-6) * (1 + 1e-9)  # sizes of similar sets lie in the same or in adjacent classes
    level = F.floor(F.log(F.col("size").cast("double")) / width)
    rows = nodes.select("node", "component", "size", "rest", F.size("tokens").alias("have"), level.alias("level"), F.posexplode("tokens").alias("pos", "token"))
    rows = rows.withColumn("left", F.col("have") - F.col("pos")).drop("have", "pos")
    nearby = F.explode(F.sequence(F.col("level") - 1, F.col("level") + 1))

    reach = rows.groupBy("token", "level").agg(F.min("size").alias("least"), F.max("rest").alias("most"))
    reach = reach.withColumn("level", nearby).groupBy("token", "level").agg(F.min("least").alias("least"), F.max("most").alias("most"))
    rows = rows.join(stored(reach, "reach"), ["token", "level"])
    rows = rows.withColumn("fit", F.greatest("least", F.ceil(F.col("size") * percent / 100)))
    rows = stored(rows.where(F.col("left") >= need_of("size", "rest", "fit", "most", percent)).drop("least", "most", "fit"), "near")

    counts = rows.groupBy("token", "component").agg(F.count(F.lit(1)).alias("rows"))
    main = counts.groupBy("token").agg(F.max(F.struct("rows", "component")).alias("most"), F.count(F.lit(1)).alias("components"))
    main = stored(main.where("components > 1").select("token", F.col("most.component").alias("main")), "main")
    rows = stored(rows.join(main, "token").withColumn("main", F.col("main") == F.col("component")), "sides")

    l, r = rows.where("NOT main").alias("l"), rows.withColumn("level", nearby).alias("r")
    need = need_of("l.size", "l.rest", "r.size", "r.rest", percent)
    met = l.join(
        r,
        (F.col("l.token") == F.col("r.token")) & (F.col("l.level") == F.col("r.level")) & (F.col("r.main") | (F.col("l.node") < F.col("r.node")))
        & (F.col("l.component") != F.col("r.component")) & similar_sizes("l.size", "r.size", percent) & (F.least("l.left", "r.left") >= need),
    )
    a, b = F.least("l.node", "r.node"), F.greatest("l.node", "r.node")
    return met.select(a.alias("a"), b.alias("b"), F.lit(0).cast("long").alias("n"), need.alias("need"))


def node_components(docs: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """Documents as (doc_id, node, n), and (node, component) for every node that is linked with another one."""
    with common.rows_per_batch(docs.sparkSession, BATCH_ROWS):
        return linked_nodes(docs, **options)


def linked_nodes(docs: DataFrame, doc: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT, limit: int = FREQUENT) -> tuple[DataFrame, DataFrame]:
    surveyed = stored(survey(docs, doc, text, size), "survey")
    members = surveyed.where("kind = 0").select(F.col("a").alias("doc_id"), F.col("b").alias("node"), "n")
    frequent = frequent_tokens(surveyed, limit)
    total = members.agg(F.sum("n")).first()[0] or 0
    buckets = max(256, total // BUCKET_TOKENS)
    partitions = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), buckets // PARTITION_BUCKETS)
    packed = postings(docs, text, frequent, buckets, size, percent)
    shared = stored(shared_tokens(packed, partitions, percent), "shared")

    first = stored(members.groupBy("node").agg(F.min("doc_id").alias("doc_id")), "first")

    # How many tokens of its prefix a node has in common with any other: no pair shares more.
    alone = shared.where("kind = 0").select("a", "b", "n", F.col("x").alias("need"))
    many = shared.where("kind = 1").select(F.col("a").alias("token"), F.col("b").alias("node"), F.col("x").alias("size"), F.col("y").alias("rest"))
    ones = many.select("node", F.lit(1).cast("long").alias("n")).unionAll(alone.select("a", "n")).unionAll(alone.select("b", "n"))
    many = stored(many.join(stored(ones.groupBy("node").agg(F.sum("n").alias("common")), "common"), "node"), "many")

    # Each node of a token that many have is compared with one of their nodes that have most in common, that with which it
    # shares most tokens.
    centres = many.groupBy("token").agg(F.max(F.struct("common", "node", "size", "rest")).alias("c"))
    centres = centres.select("token", F.col("c.node").alias("a"), F.col("c.size").alias("size_a"), F.col("c.rest").alias("rest_a"))
    stars = many.join(centres, "token").where((F.col("node") != F.col("a")) & similar_sizes("size", "size_a", percent))
    stars = stars.groupBy("a", F.col("node").alias("b")).agg(F.count(F.lit(1)).alias("n"), F.max(need_of("size", "rest", "size_a", "rest_a", percent)).alias("need"))
    stars = stars.where("n * 2 >= need").groupBy("b").agg(F.max(F.struct("n", "a")).alias("best")).select("best.a", "b")
    links = verified(stars, first, docs, doc, text, size, percent)
    names = components(links)

    # Then the pairs that could still join two components. All tokens that such a pair shares are open, or theirs alone.
    named = stored(many.join(names, "node", "left").withColumn("component", F.coalesce("component", "node")), "named")
    mixed = named.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("nodes"))
    of_open = named.join(stored(mixed.where("low < high").select("token", "nodes"), "mixed"), "token")
    firsts = [F.first(x).alias(x) for x in ("component", "size", "rest")]
    open_ = of_open.groupBy("node").agg(*firsts, F.sort_array(F.collect_list(F.struct("nodes", "token"))).alias("tokens"))
    open_ = stored(open_.withColumn("tokens", F.col("tokens.token")), "open")
    pairs = across_components(open_, percent).unionAll(alone).groupBy("a", "b").agg(F.sum("n").alias("n"), F.min("need").alias("need"))
    pairs = pairs.join(names.toDF("a", "of_a"), "a", "left").join(names.toDF("b", "of_b"), "b", "left")
    pairs = pairs.where(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select("a", "b", "n", "need")
    have = open_.select("node", F.size("tokens").alias("have"))
    pairs = pairs.join(have.toDF("a", "have_a"), "a", "left").join(have.toDF("b", "have_b"), "b", "left")
    pairs = pairs.where(F.col("n") + F.least(F.coalesce("have_a", F.lit(0)), F.coalesce("have_b", F.lit(0))) >= F.col("need"))
    pairs = stored(pairs.select("a", "b", "n", "need"), "possible")
    pairs = pairs.join(open_.select(F.col("node").alias("a"), F.col("tokens").alias("tokens_a")), "a", "left")
    pairs = pairs.join(open_.select(F.col("node").alias("b"), F.col("tokens").alias("tokens_b")), "b", "left")
    pairs = pairs.where(F.col("n") + F.coalesce(F.size(F.array_intersect("tokens_a", "tokens_b")), F.lit(0)) >= F.col("need"))
    more = verified(pairs, first, docs, doc, text, size, percent)
    names = components(more.unionAll(names.where("node != component").select(F.col("component").alias("a"), F.col("node").alias("b"))))
    return members, names


def winners(members: DataFrame, names: DataFrame) -> DataFrame:
    """(node, doc_id, winner) for every node that shares its component: the smallest doc_id there, and a node that has it."""
    counts = members.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("rows"))
    named = counts.join(names, "node", "left")
    grouped = stored(named.where("component IS NOT NULL OR rows > 1").select("node", "doc_id", F.coalesce("component", "node").alias("component")), "classes")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.col("node").alias("winner"))).alias("first")
    chosen = grouped.groupBy("component").agg(first).select("component", "first.doc_id", "first.winner")
    return stored(grouped.select("node", "component").join(chosen, "component").select("node", "doc_id", "winner"), "winners")


def join_components(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every document; the component is named by its smallest doc_id."""
    members, names = node_components(docs, **options)
    named = winners(members, names).select("node", F.col("doc_id").alias("component_id"))
    out = members.join(named, "node", "left")
    own = F.when(F.col("n") > 0, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def one_of_each(docs: DataFrame, doc: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each component: that with the smallest doc_id. Texts without words all stay.

    Of several rows with that id and the same set of shingles, the one whose JSON form has the smallest digest stays.
    """
    size = options.get("size", SHINGLE)
    frame, (own_doc, own_text) = common.numbered(docs, doc, text)
    columns = frame.columns
    decided = winners(*node_components(docs, doc=doc, text=text, **options))
    held, bits = node_filter(decided.select("node", F.lit(0).cast("long").alias("doc_id")))

    def work():
        shingler = Shingler(size)

        def run(given):
            with np.errstate(over="ignore"):
                sets = shingler.sets(given[0])
                nodes = np.array([shingler.node(s) for s in sets], np.int64)
                maybe = passes(key_of(nodes, np.zeros(len(nodes), np.int64)), held, bits) & np.array([len(s) > 0 for s in sets], bool)
            return [pa.array(nodes, pa.int64()), pa.array(maybe, pa.bool_())]

        return run

    marked = common.add_columns(frame, [own_text], [StructField("_node", LongType()), StructField("_maybe", BooleanType())], work, PART_BYTES)
    asked = marked.where("_maybe").join(decided.select(F.col("node").alias("_node"), F.col("doc_id").alias("_first"), F.col("winner").alias("_winner")), "_node", "left")
    kept = asked.where(F.col("_winner").isNull() | ((F.col("_winner") == F.col("_node")) & F.col(own_doc).cast("long").eqNullSafe(F.col("_first"))))
    # Written before rows that repeat are dropped, so that a node with many copies can be split in the join.
    row = F.struct(*columns)
    kept = stored(kept.select(*columns, "_node"), "kept").groupBy("_node").agg(F.min_by(row, F.sha2(F.to_json(row), 256)).alias("row"))
    return common.restored(marked.where(~F.col("_maybe")).select(*columns).unionAll(kept.select("row.*")), docs)
