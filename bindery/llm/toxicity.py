"""Toxicity of whole texts: a lexicon trie met with Levenshtein automata, and windows that tell quotation from abuse.

The lexicon holds words and stems with weights. Seeds are fixed; more are learned from labelled documents, words and
beginnings of words that toxic documents hold far more often than chance. Its trie is intersected with the Levenshtein
automaton of the word read: a state is the set of trie nodes that can be reached with so many errors. States are made when
first needed, so a word costs one lookup per character, and most die after a few. Short words allow no error, longer ones
one or two; stems must be exact.

Each match is weighed by its window: inside quotation marks or after a word of reporting it counts less, next to a second
person or another match more. A quotation mark counts within 60 code points of the match, a word of reporting within six
words; what stands further off does not. Features of a document are the sums and shares of its matches; a logistic regression on
labelled documents, drawn towards fixed coefficients, turns them into a score.

Labels are learned from a sample of at most SAMPLE documents, taken by a hash of their id. Null and empty texts have no
match and get the score of a text without one. Texts are read whole. Where an id has several labels the largest counts,
null labels don't. Without labels the seeds and the fixed coefficients are used. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
import sys
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField

from bindery.llm import common

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SAMPLE = 20_000  # labelled documents at most
THRESHOLD = 0.3
# Insults that every model begins with.
SEEDS = (
    "idiot idiots moron morons stupid dumb loser losers trash scum scumbag worthless pathetic disgusting clown garbage imbecile "
    "bastard asshole bitch retard jerk fool vermin crétin connard salaud abruti ordure trottel arschloch dummkopf abschaum "
    "idiota imbécil estúpido basura cabrón gilipollas"
).split()
SEED_WEIGHT = 4.0
SECOND = frozenset("you your youre u ur ya tu te toi vous votre du dich dir ihr euch tú usted ustedes vosotros".split())
REPORTING = frozenset(
    "said says say called calls quoted quote wrote writes word term phrase insult reported dit disait mot terme appelé sagte sagt "
    "wort nannte dijo dice palabra término llamó".split()
)
MARKS = "\"“”„«»"
WORD = r"\w+"
STEMS = range(4, 11)  # lengths of stems
EVIDENCE = math.log(1e6)  # a learned entry would arise by chance once in so many
# Bias, log weight, largest weight, log weight of misspelled words, matches in 100 words, quoted share, abusive windows.
PRIOR = np.array([-2.6, 0.8, 0.5, 0.4, 0.2, -0.5, 0.3])
FEATURES = len(PRIOR)
RIDGE = 0.5
KEPT_WORDS, KEPT_PLACES = 400_000, 500_000  # words, and trie nodes in all states, that a task remembers

Entry = tuple[str, bool, float]  # term, whether it is a stem, weight


def errors(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class Lexicon:
    """A trie, and the automaton that reads a word against all of its terms at once."""

    def __init__(self, entries: list[Entry]) -> None:
        self.children: list[dict[str, int]] = [{}]
        self.word, self.stem, self.allowed, self.most = [0.0], [0.0], [0], [0]
        for term, is_stem, weight in entries:
            node, may = 0, 0 if is_stem else errors(term)
            path = [0]
            for c in term:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    for values, none in ((self.word, 0.0), (self.stem, 0.0), (self.allowed, 0), (self.most, 0)):
                        values.append(none)
                node = self.children[node][c]
                path.append(node)
            for n in path:
                self.most[n] = max(self.most[n], may)
            if is_stem:
                self.stem[node] = max(self.stem[node], weight)
            else:
                self.word[node], self.allowed[node] = max(self.word[node], weight), may
        self.forget()

    def forget(self) -> None:
        self.number: dict[frozenset, int] = {}
        self.states: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.stems: list[float] = []
        self.places = 0
        self.begin = self.state({0: 0})

    def state(self, reached: dict[int, int]) -> int:
        """The number of a state; -1 if nothing is reached. Letters of a term that the word lacks are skipped here."""
        todo = list(reached.items())
        for node, e in todo:
            for child in self.children[node].values():
                if e + 1 <= self.most[child] and e + 1 < reached.get(child, 99):
                    reached[child] = e + 1
                    todo.append((child, e + 1))
        if not reached:
            return -1
        key = frozenset(reached.items())
        if key not in self.number:
            self.number[key] = len(self.states)
            self.states.append(key)
            self.places += len(key)
            self.moves.append({})
            self.stems.append(max((self.stem[n] for n, e in key if e == 0), default=0.0))
        return self.number[key]

    def move(self, state: int, c: str) -> int:
        reached: dict[int, int] = {}
        for node, e in self.states[state]:
            same = self.children[node].get(c)
            if same is not None and e < reached.get(same, 99):
                reached[same] = e
            if e + 1 <= self.most[node]:
                if e + 1 < reached.get(node, 99):
                    reached[node] = e + 1  # c is one too many
                for child in self.children[node].values():
                    if child != same and e + 1 <= self.most[child] and e + 1 < reached.get(child, 99):
                        reached[child] = e + 1
        to = self.moves[state][c] = self.state(reached)
        return to

    def match(self, word: str) -> tuple[float, bool]:
        """Weight of the best term for ``word``, 0 if there is none, and whether it is spelled right."""
        state, stem = self.begin, 0.0
        for c in word:
            to = self.moves[state].get(c)
            state = self.move(state, c) if to is None else to
            if state < 0:
                return stem, True
            stem = max(stem, self.stems[state])
        exact = max((self.word[n] for n, e in self.states[state] if e == 0), default=0.0)
        near = max((self.word[n] for n, e in self.states[state] if 0 < e <= self.allowed[n]), default=0.0)
        if self.places > KEPT_PLACES:
            self.forget()
        return (max(stem, exact), True) if stem or exact else (near / 2, False)


class Scorer:
    """Features of texts."""

    def __init__(self, entries: list[Entry]) -> None:
        self.lexicon, self.known = Lexicon(entries), {}
        self.find = re.compile(WORD)

    def matched(self, words: list[str]) -> bool:
        """Look up words not seen before; whether any word has a match."""
        known = self.known
        if len(known) > KEPT_WORDS:
            known.clear()
        for w in set(words).difference(known):
            weight, right = self.lexicon.match(w)
            known[w] = (weight, right) if weight else None
        return any(map(known.__getitem__, words))

    def features(self, text: str | None) -> list[float]:
        text = (text or "").lower()
        words = self.find.findall(text)
        if not words or not self.matched(words):
            return [1.0] + [0.0] * (FEATURES - 1)
        spans = [m.span() for m in self.find.finditer(text)]
        at = [i for i, w in enumerate(words) if self.known[w]]
        right = wrong = largest = 0.0
        quoted_count = abusive_count = 0
        places = set(at)
        for i in at:
            weight, spelled = self.known[words[i]]
            start, end = spans[i]
            before, after = text[max(0, start - 60) : start].rpartition("\n")[2], text[end : end + 60].partition("\n")[0]
            quoted = any(c in before for c in MARKS) and any(c in after for c in MARKS)
            reported = not REPORTING.isdisjoint(words[max(0, i - 6) : i])
            abusive = not SECOND.isdisjoint(words[max(0, i - 3) : i + 4]) or any(j in places for j in range(i - 6, i + 7) if j != i)
            value = weight * (0.3 if quoted else 1) * (0.6 if reported else 1) * (1.3 if abusive else 1)
            quoted_count += quoted
            abusive_count += abusive
            if spelled:
                right, largest = right + value, max(largest, value)
            else:
                wrong += value
        return [
            1.0, math.log1p(right), largest, math.log1p(wrong), math.log1p(100 * len(at) / len(words)),
            quoted_count / len(at), math.log1p(abusive_count),
        ]


def held_out(doc: Column) -> Column:
    """Documents whose labels are not to be learned from. A null id is none of them."""
    return F.coalesce(F.crc32(doc.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, bound: int) -> DataFrame:
    """(doc_id, text, toxic) of at most ``bound`` labelled documents that aren't held out, the same ones on every run."""
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    known = known.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    share = min(1.0, 1.1 * bound / max(1, known.count()))
    chosen = known.where(order < F.lit(int(share * (1 << 30)))).orderBy(order, "doc_id").limit(bound)
    # At most ``bound`` rows of two numbers, so every task can hold them.
    rows = [tuple(r) for r in chosen.collect()]
    chosen = docs.sparkSession.createDataFrame(rows, f"doc_id {dict(docs.dtypes)['doc_id']}, toxic int")
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def learn_lexicon(sample: DataFrame) -> list[Entry]:
    """Seeds, and words and stems of which toxic documents have more than chance explains."""

    def work(batches):
        find, toxic, clean = re.compile(WORD), Counter(), Counter()
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = set(find.findall((text or "").lower()))
                terms = words | {w[:n] + "*" for w in words for n in STEMS if n < len(w)}
                (toxic if label else clean).update(terms)
                (toxic if label else clean)[""] += 1
        terms = list(toxic.keys() | clean.keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(terms, pa.string()), pa.array([toxic[t] for t in terms], pa.int64()), pa.array([clean[t] for t in terms], pa.int64())],
            names=["term", "toxic", "clean"],
        )

    counts = sample.select("text", "toxic").mapInArrow(work, "term string, toxic long, clean long")
    counts = counts.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    # A term of the sample's vocabulary can only be evidence if enough toxic documents hold it.
    rows = {r.term: (r.toxic, r.clean) for r in counts.where("term = '' OR toxic >= 4 AND toxic > clean").collect()}
    a_all, c_all = rows.pop("", (0, 0))
    entries = {(w, False): SEED_WEIGHT for w in SEEDS}
    if a_all and c_all:
        share = a_all / (a_all + c_all)
        for term, (a, c) in rows.items():
            rate = a / (a + c)
            if rate <= share:
                continue
            surprise = a * math.log(rate / share) + (c * math.log((1 - rate) / (1 - share)) if c else 0)
            if surprise >= EVIDENCE:
                odds = math.log((a + 0.5) / (a_all + 1)) - math.log((c + 0.5) / (c_all + 1))
                key = (term.rstrip("*"), term.endswith("*"))
                entries[key] = min(6.0, max(odds, 0.5))
    return [(term, is_stem, weight) for (term, is_stem), weight in sorted(entries.items())]


def fit(rows: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Coefficients of a logistic regression, drawn towards PRIOR. A Newton step is halved until it lowers the loss, so it converges."""

    def loss(beta):
        z = rows @ beta
        return np.sum(np.logaddexp(0, z) - labels * z) + RIDGE / 2 * np.sum((beta - PRIOR) ** 2)

    beta = PRIOR.copy()
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(rows @ beta, -30, 30)))
        slope = rows.T @ (labels - p) - RIDGE * (beta - PRIOR)
        curve = (rows * (p * (1 - p))[:, None]).T @ rows + RIDGE * np.eye(FEATURES)
        change = np.linalg.solve(curve, slope)
        now = loss(beta)
        while np.abs(change).max() > 1e-7 and not loss(beta + change) < now:
            change = change / 2
        beta = beta + change
        if np.abs(change).max() < 1e-6:
            break
    return beta


def train(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> tuple[list[Entry], np.ndarray]:
    """Lexicon and coefficients. What the driver gets is bounded by the sample's ``bound`` documents."""
    sample = training_sample(docs, labels, bound)
    entries = learn_lexicon(sample)
    names = [f"f{i}" for i in range(FEATURES)]
    fields = [StructField(n, DoubleType()) for n in names]
    rows = common.add_columns(sample, ["text"], fields, feature_work(entries))
    # One row for each id, also where documents repeat.
    rows = rows.groupBy("doc_id").agg(F.max(F.struct("toxic", *names)).alias("row")).select("row.*").collect()
    table = np.array([list(r) for r in rows], float).reshape(len(rows), FEATURES + 1)
    return entries, fit(table[:, 1:], table[:, 0])


def feature_work(entries: list[Entry]):
    def work():
        scorer = Scorer(entries)

        def run(columns):
            table = np.array([scorer.features(t) for t in columns[0].to_pylist()], float).reshape(-1, FEATURES)
            return [pa.array(table[:, i]) for i in range(FEATURES)]

        return run

    return work


def score(docs: DataFrame, model: tuple[list[Entry], np.ndarray], text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 if the score is at least THRESHOLD)."""
    entries, beta = model

    def work():
        features = feature_work(entries)()

        def run(columns):
            table = np.stack([c.to_numpy() for c in features(columns)], 1)
            scores = 1 / (1 + np.exp(-np.clip(table @ beta, -30, 30)))
            return [pa.array(scores), pa.array(scores >= THRESHOLD).cast(pa.int64())]

        return run

    return common.add_columns(docs, [text], [StructField("score", DoubleType()), StructField("predicted", LongType())], work)


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that aren't predicted to be toxic, unchanged."""
    frame, (text,) = common.numbered(docs, "text")
    return common.restored(score(frame, train(docs, labels), text).where("predicted = 0"), docs)
