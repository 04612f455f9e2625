"""Secrets in whole texts: fixed forms, and runs of symbols that a battery of tests takes for random.

A run is any stretch of 20 or more code points of the base64 alphabets. Its encoding is the smallest alphabet that holds
it. Three tests ask whether it may be random in that alphabet: chi-squared for equal shares of the symbols, runs above and
below the middle, serial correlation of neighbours. A run that any of them rejects is left alone. What is left is tested
against the other hypothesis, ordinary text: text uses few symbols often, so its chi-squared grows with length, and the
chance that text of that length looks as even as the run is its p-value. Benjamini and Hochberg's rule decides on the
p-values of all documents, separately for each encoding and length class, so the many short runs, of which tests can say
little, don't decide about long ones. P-values are rounded up to steps, so counts per step (a table of bounded size) are
all that is gathered. Runs that touch a fixed form are not tested.

Nulls and empty texts have no spans. Texts are scanned whole. Repeated rows get equal spans, and count each for the rule.
An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re
import sys
from collections import Counter
from collections.abc import Iterable

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from bindery.llm import common

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed forms: name, pattern, the group whose length counts, the least length.
FORMS = (
    ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
)
KINDS = ("assign", "access", "hex", "random")
RUN = r"[A-Za-z0-9+/_-]{20,}={0,2}"
# Alphabets in the order in which they are tried.
ALPHABETS = (
    ("decimal", "0123456789"),
    ("hex_lower", "0123456789abcdef"),
    ("hex_upper", "0123456789ABCDEF"),
    ("lower", "abcdefghijklmnopqrstuvwxyz"),
    ("upper", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("lower_alnum", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("upper_alnum", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("alnum", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
    ("any64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_"),
)
PLACES = {name: {c: i for i, c in enumerate(symbols)} for name, symbols in ALPHABETS}
# Chance that two symbols drawn from ordinary text are equal.
COINCIDENCE = 0.06
REJECT, RATE, STEPS = 0.001, 0.01, 8  # level of the tests for randomness, false discovery rate, p-value steps in a factor of 2
LONGEST = 1074 * STEPS

Span = tuple[int, int, str]


def upper_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def chi_tail(x: float, df: float) -> float:
    """Chance of a chi-squared above ``x``, by the cube root's normal approximation."""
    return upper_tail(((max(x, 0) / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df)))


def encoding_of(run: str) -> str:
    used = set(run)
    return next(name for name, _ in ALPHABETS if used <= PLACES[name].keys())


def battery(run: str) -> tuple[str, tuple[float, float, float], float]:
    """Encoding, p-values of the three tests for randomness, and the p-value of ordinary text."""
    name = encoding_of(run)
    place, n = PLACES[name], len(run)
    k, values = len(place), [place[c] for c in run]
    expected = n / k
    chi = sum(v * v for v in Counter(values).values()) / expected - n
    uniform = chi_tail(chi, k - 1)

    high = [2 * v >= k for v in values]
    a = sum(high)
    b = n - a
    if a and b:
        mean = 2 * a * b / n + 1
        variance = (mean - 1) * (mean - 2) / (n - 1)
        runs = 1 + sum(x != y for x, y in zip(high, high[1:]))
        change = 2 * upper_tail(abs(runs - mean) / math.sqrt(variance)) if variance > 0 else 1.0
    else:
        change = 2.0 ** (1 - n)

    middle = sum(values) / n
    spread = sum((v - middle) ** 2 for v in values)
    if spread:
        serial = sum((x - middle) * (y - middle) for x, y in zip(values, values[1:])) / spread
        follow = 2 * upper_tail(abs(serial + 1 / n) * math.sqrt(n))
    else:
        follow = 0.0

    shift = (n - 1) * max(k * COINCIDENCE - 1, 0.25)  # of chi-squared, for ordinary text
    scale = (k - 1 + 2 * shift) / (k - 1 + shift)
    text = 1 - chi_tail(chi / scale, (k - 1 + shift) ** 2 / (k - 1 + 2 * shift))
    return name, (uniform, change, follow), max(text, 5e-324)


def length_class(n: int) -> int:
    """Two classes in each doubling of the length."""
    return int(2 * math.log2(n))


def fixed_spans(text: str, patterns: list[tuple[str, re.Pattern, int, int]]) -> list[Span]:
    return [(m.start(), m.end(), kind) for kind, p, group, least in patterns for m in p.finditer(text) if m.end(group) - m.start(group) >= least]


def compiled() -> list[tuple[str, re.Pattern, int, int]]:
    made = []
    for kind, pattern, group, least in FORMS:
        # In a run of one class a longer least length only skips matches that would be dropped.
        if group == 0:
            pattern = f"{pattern[:-1]}{{{least - (4 if kind == 'access' else 0)},}}"
        made.append((kind, re.compile(pattern, (re.IGNORECASE if kind == "assign" else 0) | re.ASCII), group, least))
    return made


def random_runs(text: str, taken: list[Span], pattern: re.Pattern) -> list[tuple[Span, str, int, int]]:
    """Runs that may be random and touch no span of ``taken``: span, encoding, length class, p-value step."""
    found = []
    for m in pattern.finditer(text):
        start, end = m.span()
        if any(a < end and start < b for a, b, _ in taken):
            continue
        name, random, p = battery(m.group().rstrip("="))
        if min(random) >= REJECT:
            found.append(((start, end, "random"), name, length_class(end - start), int(-math.log2(p) * STEPS)))
    return found


def thresholds(counts: Iterable[tuple[str, int, int, int]], rate: float = RATE) -> dict[tuple[str, int], int]:
    """For each encoding and length class the least step that is a discovery. ``counts``: encoding, class, step, runs.

    Step s stands for p-values up to 2 ** (-s / STEPS). The rule takes the largest p with p <= rate * (runs up to p) / runs.
    """
    strata: dict[tuple[str, int], Counter] = {}
    for name, size, at, n in counts:
        strata.setdefault((name, size), Counter())[at] += n
    least = {}
    for key, steps in strata.items():
        total, below = sum(steps.values()), 0
        for at in sorted(steps, reverse=True):
            below += steps[at]
            if 2.0 ** (-at / STEPS) <= rate * below / total:
                least[key] = at
    return least


def run_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """How many runs that may be random there are, by encoding, length class and p-value step."""
    schema = "encoding string, length_class long, step long, runs long"

    def work(batches):
        patterns, run = compiled(), re.compile(RUN)
        total = Counter()
        for batch in batches:
            for value in batch.column(0).to_pylist():
                if value:
                    total.update(x[1:] for x in random_runs(value, fixed_spans(value, patterns), run))
        rows = [(*k, n) for k, n in total.items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], pa.string() if i == 0 else pa.int64()) for i in range(4)], names=["encoding", "length_class", "step", "runs"]
        )

    counted = docs.select(common.named(text).alias("text")).mapInArrow(work, schema)
    return counted.groupBy("encoding", "length_class", "step").agg(F.sum("runs").alias("runs"))


def learn(docs: DataFrame, text: str = "text") -> dict[tuple[str, int], int]:
    """Thresholds over all documents. The rows fetched are at most encodings x length classes x steps, whatever the input."""
    return thresholds(tuple(r) for r in run_counts(docs, text).collect())


def spans_of(text: str | None, least: dict[tuple[str, int], int], patterns: list, run: re.Pattern) -> list[Span]:
    """All spans of a text by start, then by kind in the order of KINDS."""
    if not text:
        return []
    fixed = fixed_spans(text, patterns)
    never = LONGEST + 1
    added = [span for span, name, size, at in random_runs(text, fixed, run) if at >= least.get((name, size), never)]
    return sorted(fixed + added, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``secrets``, an array of (start, end, kind); code points, end exclusive."""
    least = learn(docs, text)
    item = StructType([StructField("start", LongType()), StructField("end", LongType()), StructField("kind", StringType())])

    def work():
        patterns, run = compiled(), re.compile(RUN)

        def found(columns):
            values = [[dict(zip(("start", "end", "kind"), s)) for s in spans_of(t, least, patterns, run)] for t in columns[0].to_pylist()]
            return [pa.array(values, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())])))]

        return found

    return common.add_columns(docs, [text], [StructField("secrets", ArrayType(item))], work)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def digest(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with counts of the fixed forms, the digest of their spans, and all spans as text."""
    least = learn(docs, text)
    counts = [StructField(f"n_{k}", LongType()) for k in KINDS]
    fields = counts + [StructField("base_sha256", StringType()), StructField("spans", StringType())]

    def work():
        patterns, run = compiled(), re.compile(RUN)

        def found(columns):
            each = [spans_of(t, least, patterns, run) for t in columns[0].to_pylist()]
            kinds = [Counter(s[2] for s in x) for x in each]
            base = [joined([s for s in x if s[2] != "random"]) for x in each]
            return [pa.array([c[k] for c in kinds], pa.int64()) for k in KINDS] + [
                pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base], pa.string()),
                pa.array([joined(x) for x in each], pa.string()),
            ]

        return found

    return common.add_columns(docs, [text], fields, work)


def redact(docs: DataFrame, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """``docs`` with every span in ``text`` replaced by ``mark``; spans that overlap become one."""
    least = learn(docs, text)
    frame, (own,) = common.numbered(docs, text)

    def work():
        patterns, run = compiled(), re.compile(RUN)

        def cut(value):
            out, at = [], 0
            for a, b, _ in spans_of(value, least, patterns, run):
                if a >= at:
                    out += [value[at:a], mark]
                at = max(at, b)
            return value if not out else "".join(out) + value[at:]

        return lambda given: [pa.array([cut(t) for t in given[0].to_pylist()], pa.string())]

    return common.restored(common.add_columns(frame, [own], [StructField(own, StringType())], work), docs)
