"""Fingerprints of whole texts from prefix polynomial hashes.

The hash of every prefix, modulo two primes below 2 ** 31, answers whether two spans are equal from four numbers, and a
binary search over lengths gives the longest common extension of two positions. A fingerprint keeps what such arrays answer
best: the hash of the whole text, hashes of its prefixes at fixed lengths that grow by a quarter, and the smallest hashes
of its spans of SPAN code points. Two fingerprints are alike by the longer of two estimates: the longest common prefix, by
binary search over the prefix lengths both have, as a share of the longer text; and the share of common spans.

Nulls and empty texts have the fingerprint of the empty text, alike only to themselves. Texts are read whole; the arrays of
one text are in memory at a time. Equal texts have equal fingerprints. Rows that repeat get equal results, and follow each
other in the order of ids. In an empty table nothing follows; the only row of a table follows itself.
"""

from __future__ import annotations

import hashlib
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField

from bindery.llm import common
from bindery.llm.neighbours import in_order

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PRIMES = (2147483647, 2147483629)
BASES = (1_000_003, 1_999_993)
SPAN, SKETCH = 16, 64
LENGTHS = [16]
while LENGTHS[-1] < 1 << 40:
    LENGTHS.append(LENGTHS[-1] * 5 // 4)


class Powers:
    """Powers of the bases and of their inverses, made as far as needed."""

    def __init__(self) -> None:
        self.up = [np.ones(1, np.uint64) for _ in PRIMES]
        self.down = [np.ones(1, np.uint64) for _ in PRIMES]

    def reach(self, n: int) -> None:
        for k, (p, b) in enumerate(zip(PRIMES, BASES)):
            for table, base in ((self.up, b), (self.down, pow(b, -1, p))):
                while len(table[k]) <= n:
                    have = table[k]
                    table[k] = np.concatenate([have, have * np.uint64(pow(base, len(have), p)) % np.uint64(p)])


def points_of(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)


class PrefixHashes:
    """Hashes of all prefixes of a text."""

    def __init__(self, points: np.ndarray, powers: Powers) -> None:
        powers.reach(len(points))
        self.n, self.powers, self.sums = len(points), powers, []
        values = points.astype(np.uint64) + np.uint64(1)
        for k, p in enumerate(PRIMES):
            sums = np.zeros(len(points) + 1, np.uint64)
            np.cumsum(values * powers.up[k][: len(points)] % np.uint64(p), out=sums[1:])
            self.sums.append(sums % np.uint64(p))

    def spans(self, start, end) -> np.ndarray:
        """Hashes of spans, the same wherever a span stands: both primes' in one number."""
        parts = []
        for k, p in enumerate(PRIMES):
            p = np.uint64(p)
            parts.append((self.sums[k][end] + p - self.sums[k][start]) % p * self.powers.down[k][start] % p)
        return parts[0] << np.uint64(31) | parts[1]

    def equal(self, start: int, other: PrefixHashes, other_start: int, length: int) -> bool:
        return bool(self.spans(start, start + length) == other.spans(other_start, other_start + length))

    def extension(self, start: int, other: PrefixHashes, other_start: int) -> int:
        """Length of the longest common extension from two positions."""
        low, high = 0, min(self.n - start, other.n - other_start)
        while low < high:
            middle = (low + high + 1) // 2
            if self.equal(start, other, other_start, middle):
                low = middle
            else:
                high = middle - 1
        return low


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def fingerprint(points: np.ndarray, powers: Powers) -> str:
    """length.whole.prefixes.spans, in hexadecimal; prefixes and span hashes have 8 digits each."""
    hashes, n = PrefixHashes(points, powers), len(points)
    lengths = np.array([m for m in LENGTHS if m <= n], np.int64)
    prefixes = mixed(hashes.spans(np.zeros(len(lengths), np.int64), lengths)) >> np.uint64(32)
    starts = np.arange(max(n - SPAN + 1, min(n, 1)))
    spans = mixed(hashes.spans(starts, np.minimum(starts + SPAN, n)))
    room = 4 * SKETCH
    while True:  # the smallest distinct ones, without sorting all
        some = spans if room >= len(spans) else np.partition(spans, room)[:room]
        least = np.unique(some)[:SKETCH]
        if len(least) == SKETCH or room >= len(spans):
            break
        room *= 4
    least = least >> np.uint64(32)
    whole = int(hashes.spans(0, n))
    return f"{n:x}.{whole:016x}.{''.join(f'{x:08x}' for x in prefixes.tolist())}.{''.join(f'{x:08x}' for x in least.tolist())}"


def likeness(a: str, b: str) -> float:
    """How alike two fingerprints are, 0 to 1."""
    if a == b:
        return 1.0
    (n_a, _, prefixes_a, spans_a), (n_b, _, prefixes_b, spans_b) = a.split("."), b.split(".")
    n_a, n_b = int(n_a, 16), int(n_b, 16)
    if not n_a or not n_b:
        return 0.0
    low, high = 0, min(len(prefixes_a), len(prefixes_b)) // 8
    while low < high:
        middle = (low + high + 1) // 2
        if prefixes_a[8 * middle - 8 : 8 * middle] == prefixes_b[8 * middle - 8 : 8 * middle]:
            low = middle
        else:
            high = middle - 1
    prefix = LENGTHS[low - 1] / max(n_a, n_b) if low else 0.0
    x, y = ({s[i : i + 8] for i in range(0, len(s), 8)} for s in (spans_a, spans_b))
    union = sorted(x | y)[: min(SKETCH, max(len(x), len(y)))]
    same = sum(u in x and u in y for u in union) / len(union)
    return max(prefix, 2 * same / (1 + same))


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``fingerprint``."""

    def work():
        powers = Powers()
        return lambda columns: [pa.array([fingerprint(points_of(t), powers) for t in columns[0].to_pylist()], pa.string())]

    return common.add_columns(docs, [text], [StructField("fingerprint", StringType())], work)


def against_next(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document's fingerprint, that of its text edited with the next document's, and how alike they and the next are.

    The next document has the next smaller id, after the smallest comes the largest. Rows of one id are ordered by text; a
    null id is the smallest. The edit replaces the last third (rounded down) by as many first code points of the next text,
    or all that it has.
    """
    schema = (
        f"doc_id {dict(docs.dtypes)[doc]}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    source = docs.select(
        F.col(doc).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.coalesce(-F.col(doc).cast("long"), F.lit(2**63 - 1)).alias("key")
    )
    ordered = in_order(source, ["key"], ["text"], wrap=True)

    def work(batches):
        powers = Powers()
        held = None  # a row waits for the next one: id, text, code points, fingerprint, whether it is a copy, bucket
        done = False

        def result(row, following):
            points, cut = row[2], len(row[2]) // 3
            edited = np.concatenate([points[: len(points) - cut], following[2][:cut]])
            print_ = fingerprint(edited, powers)
            digest = hashlib.sha256(edited.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")).hexdigest()
            return (row[0], len(points), digest, row[3], print_, likeness(row[3], print_), likeness(row[3], following[3]))

        for batch in batches:
            out = []
            for doc_id, value, bucket, ghost in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "text", "_bucket", "_ghost")]):
                if held and held[5] != bucket:
                    held, done = None, False
                if done:
                    continue  # only the first copy follows
                points = points_of(value)
                row = (doc_id, value, points, fingerprint(points, powers), ghost, bucket)
                if held:
                    out.append(result(held, row))
                held, done = row, ghost == 1
            columns = list(zip(*out)) or [[] for _ in range(7)]
            types = [batch.schema.field("doc_id").type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=schema_names)

    schema_names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return ordered.select("doc_id", "text", "_bucket", "_ghost").mapInArrow(work, schema)
