"""Byte-level BPE: pre-tokens found by a scan over transition functions, pairs merged once per distinct pre-token.

The splitting pattern is a finite automaton over classes of code points, where some classes look one code point ahead.
Each class is a function from state to state. The functions that can arise by composing them are few, so they are
numbered, and a table holds the number of every composition. Composition is associative: all blocks of a text are
composed side by side, one table lookup per code point, and the blocks' functions are composed last. That gives the state
before every code point, and with it where pre-tokens begin.

Nulls and empty texts have no tokens. Texts of any length are encoded whole; merging takes n log n steps.
Repeated rows are encoded alike. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import sys
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField

from bindery.llm import common

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Code points of the White_Space property.
SPACES = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# Letters and numbers of Unicode 16.0 that Python's database of 15.1 doesn't have yet, first and last code points.
NEW_LETTERS = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7),
    (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C),
    (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
]
NEW_NUMBERS = [
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9),
    (0x1E5F1, 0x1E5FA),
]
LETTER, NUMBER, SPACE, WHITE, QUOTE, OTHER = range(6)
# Symbols: classes with what follows taken into account. ENDS: letters that complete a contraction alone; OPENS: those
# that do with the next one; *_LAST: white space before something else.
(S_LETTER, S_ENDS, S_OPENS, S_NUMBER, S_SPACE, S_SPACE_LAST, S_WHITE, S_WHITE_LAST, S_QUOTE, S_OTHER), SYMBOLS = range(10), 10
# States: what the last code point was part of. In QUOTED an apostrophe began the pre-token, in OPENED it and a letter
# wait for one more, in CLOSED a contraction is complete.
(NONE, IN_LETTERS, IN_NUMBERS, IN_OTHERS, QUOTED, OPENED, CLOSED, AFTER_SPACE, AFTER_WHITE), STATES = range(9), 9
WIDTH = 256
CACHED_BYTES = 100 << 20
# Text bytes encoded at a time. Every pre-token of a part is a Python object for a while, so a part takes many times its bytes.
TEXT_BYTES = 512 << 10


def step(state: int, symbol: int) -> tuple[int, bool]:
    """The next state, and whether a pre-token begins at this code point."""
    if symbol in (S_LETTER, S_ENDS, S_OPENS):
        if state == QUOTED and symbol == S_ENDS or state == OPENED:
            return CLOSED, False
        if state == QUOTED and symbol == S_OPENS:
            return OPENED, False
        return IN_LETTERS, state not in (IN_LETTERS, AFTER_SPACE)
    if symbol == S_NUMBER:
        return IN_NUMBERS, state not in (IN_NUMBERS, AFTER_SPACE)
    if symbol in (S_QUOTE, S_OTHER):
        inside = state in (IN_OTHERS, QUOTED, AFTER_SPACE)
        return (QUOTED if symbol == S_QUOTE and not inside else IN_OTHERS), not inside
    begins = state not in (AFTER_SPACE, AFTER_WHITE) or symbol in (S_SPACE_LAST, S_WHITE_LAST)
    return (AFTER_SPACE if symbol in (S_SPACE, S_SPACE_LAST) else AFTER_WHITE), begins


class Splitter:
    """Where pre-tokens begin in texts given as code points."""

    def __init__(self) -> None:
        kinds = {"L": LETTER, "N": NUMBER}
        self.classes = np.fromiter((kinds.get(unicodedata.category(chr(i))[0], OTHER) for i in range(0x110000)), np.uint8, 0x110000)
        for kind, ranges in ((LETTER, NEW_LETTERS), (NUMBER, NEW_NUMBERS)):
            for low, high in ranges:
                self.classes[low : high + 1] = kind
        self.classes[SPACES] = WHITE
        self.classes[32], self.classes[39] = SPACE, QUOTE
        maps = [tuple(step(q, s)[0] for q in range(STATES)) for s in range(SYMBOLS)]
        maps += [(step(NONE, s)[0],) * STATES for s in range(SYMBOLS)]  # the same at the start of a text
        number = {tuple(range(STATES)): 0}
        for m in maps:
            number.setdefault(m, len(number))
        known = list(number)
        for m in known:  # grows until closed under composition
            for g in maps:
                made = tuple(g[q] for q in m)
                if made not in number:
                    number[made] = len(number)
                    known.append(made)
        self.count = len(known)
        self.composed = np.array([[number[tuple(b[q] for q in a)] for b in known] for a in known], np.uint16).ravel()
        self.apply = np.array(known, np.uint8).ravel()
        self.generators = np.array([number[m] for m in maps], np.uint16)
        begins = [[step(q, s)[1] for s in range(SYMBOLS)] + [True] * SYMBOLS for q in range(STATES)]
        self.begins = np.array(begins, bool).ravel()

    def symbols(self, points: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Symbol of each code point; ``first`` marks those that begin a text."""
        kind = self.classes[points]
        table = np.array([S_LETTER, S_NUMBER, S_SPACE, S_WHITE, S_QUOTE, S_OTHER], np.uint8)
        out = table[kind]
        following = np.append(points[1:], 0)
        more = ~np.append(first[1:], True)  # another code point of the same text follows
        white = (kind == SPACE) | (kind == WHITE)
        out[white & more & ~np.append(white[1:], False)] += 1  # to *_LAST
        low = np.flatnonzero((points >= 100) & (points <= 118))
        letter, after, has = points[low], following[low], more[low]
        out[low[np.isin(letter, [ord(c) for c in "stmd"])]] = S_ENDS
        e, l = ord("e"), ord("l")
        opens = has & (((letter == ord("r")) & (after == e)) | ((letter == ord("v")) & (after == e)) | ((letter == l) & (after == l)))
        out[low[opens]] = S_OPENS
        return out + SYMBOLS * first

    def starts(self, points: np.ndarray, first: np.ndarray) -> np.ndarray:
        n = len(points)
        if not n:
            return np.zeros(0, bool)
        symbols = self.symbols(points, first)
        rows = -(-n // WIDTH)
        steps = np.zeros(rows * WIDTH, np.uint16)  # 0: the identity
        steps[:n] = self.generators[symbols]
        steps = np.ascontiguousarray(steps.reshape(rows, WIDTH).T)
        for j in range(1, WIDTH):
            steps[j] = self.composed[steps[j - 1].astype(np.int32) * self.count + steps[j]]
        total, gap = steps[-1].astype(np.int32), 1
        while gap < rows:
            total[gap:] = self.composed[total[:-gap] * self.count + total[gap:]]
            gap *= 2
        carried = np.full(rows, NONE, np.uint8)
        carried[1:] = self.apply[total[:-1] * STATES + NONE]
        before = np.empty((WIDTH, rows), np.uint8)
        before[0] = carried
        before[1:] = self.apply[steps[:-1].astype(np.int32) * STATES + carried]
        before = np.ascontiguousarray(before.T).ravel()[:n]
        return self.begins[before.astype(np.int32) * (2 * SYMBOLS) + symbols]


def merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one pre-token, with a heap of pairs over a linked list. For the few that are long."""
    n = len(piece)
    end, after, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    alive = bytearray(b"\x01") * n
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = after[i] if alive[i] else n
        if j >= n or end[j] != stop:
            continue
        end[i], after[i], alive[j] = stop, after[j], 0
        if after[i] < n:
            before[after[i]] = i
            if (r := ranks.get(piece[i : end[after[i]]])) is not None:
                heapq.heappush(heap, (r, i, end[after[i]]))
        if before[i] >= 0 and (r := ranks.get(piece[before[i] : stop])) is not None:
            heapq.heappush(heap, (r, before[i], stop))
    return [ranks[piece[i : end[i]]] for i in range(n) if alive[i]]


def read_ranks(content: bytes) -> dict[bytes, int]:
    """Ranks of a vocabulary file: a token in base64 and its rank on each line."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines())}


class Merger:
    """Merges many distinct pre-tokens side by side, one row of a matrix each."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks, self.none = ranks, np.int32(2**31 - 1)
        pairs = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.pairs = np.array(sorted(pairs) or [-1], np.int64)
        self.pair_ranks = np.array([pairs.get(int(k), self.none) for k in self.pairs], np.int32)
        self.byte_ids = np.array([ranks[bytes([i])] for i in range(256)], np.int32)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of what a pair of tokens merges to; a negative token never merges."""
        key = left.astype(np.int64) << 32 | np.maximum(right, 0)
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where((self.pairs[at] == key) & (right >= 0), self.pair_ranks[at], self.none)

    def rows(self, pieces: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of pieces of at most ``width`` bytes, joined, and how many each has.

        In each round every row merges its pair of lowest rank, the leftmost of equals.
        """
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(len(pieces), width)
        sizes = np.array([len(p) for p in pieces])
        tokens = np.where(np.arange(width) < sizes[:, None], self.byte_ids[raw], -1).astype(np.int32)
        ranks = np.full((len(pieces), width), self.none, np.int32)  # of the pair that begins at a token
        ranks[:, :-1] = self.rank(tokens[:, :-1], tokens[:, 1:])
        done = np.full((len(pieces), width), -1, np.int32)
        left, columns = np.arange(len(pieces)), np.arange(width)
        while len(left):
            at = ranks.argmin(1)
            lowest = ranks[np.arange(len(left)), at]
            busy = lowest < self.none
            if not busy.all():
                done[left[~busy]] = tokens[~busy]
                left, tokens, ranks, at, lowest = left[busy], tokens[busy], ranks[busy], at[busy], lowest[busy]
            row, later = np.arange(len(left)), columns[:-1] > at[:, None]
            tokens[:, :-1] = np.where(later, tokens[:, 1:], tokens[:, :-1])
            ranks[:, :-1] = np.where(later, ranks[:, 1:], ranks[:, :-1])
            tokens[:, -1], ranks[:, -1] = -1, self.none
            tokens[row, at] = lowest
            ranks[row, at] = self.rank(lowest, tokens[row, np.minimum(at + 1, width - 1)] if width > 1 else np.full(len(row), -1))
            before = np.flatnonzero(at > 0)
            ranks[before, at[before] - 1] = self.rank(tokens[before, at[before] - 1], lowest[before])
        return done[done >= 0], (done >= 0).sum(1)


class Seen(dict):
    """The number of each distinct pre-token, with the token ids of each number."""

    def __init__(self, merger: Merger) -> None:
        self.merger, self.ids, self.ends, self.held = merger, np.zeros(0, np.int32), np.zeros(1, np.int64), 0

    def add(self, pieces: list[bytes]) -> None:
        """Merge pre-tokens that are new."""
        ranks, groups, ids, counts = self.merger.ranks, {}, [], []
        for piece in pieces:
            width = 0 if piece in ranks else next((w for w in (8, 12, 16, 24, 32, 64) if len(piece) <= w), -1)
            groups.setdefault(width, []).append(piece)
        for width, group in groups.items():
            if width > 0:
                flat, sizes = self.merger.rows(group, width)
            else:
                lists = [[ranks[p]] if width == 0 else merge_long(p, ranks) for p in group]
                flat, sizes = np.array([i for x in lists for i in x], np.int32), np.array([len(x) for x in lists])
            ids.append(flat)
            counts.append(sizes)
            self.update(zip(group, range(len(self), len(self) + len(group))))
            self.held += sum(map(len, group)) + 150 * len(group)
        if pieces:
            self.ids = np.concatenate([self.ids, *ids])
            self.ends = np.append(self.ends, self.ends[-1] + np.cumsum(np.concatenate(counts)))


def gathered(flat: np.ndarray, ends: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``flat[ends[k]:ends[k + 1]]`` for all numbers k, joined, and where each ends."""
    sizes = ends[numbers + 1] - ends[numbers]
    stops = np.cumsum(sizes)
    return flat[np.repeat(ends[numbers] - stops + sizes, sizes) + np.arange(stops[-1] if len(stops) else 0)], stops


class ByteBpe:
    """Encoder and decoder for one vocabulary."""

    def __init__(self, content: bytes) -> None:
        self.ranks = read_ranks(content)
        self.splitter = Splitter()
        self.seen = Seen(Merger(self.ranks))
        by_id = {rank: token for token, rank in self.ranks.items()}
        tokens = [by_id.get(i, b"") for i in range(max(by_id, default=-1) + 1)]
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.token_ends = np.cumsum([0] + [len(t) for t in tokens])

    def encode(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts, and where each text's ids end. ``data`` and ``ends`` are bytes and their bounds."""
        raw = data.tobytes()
        points = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
        at = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))  # byte place of each code point
        first = np.zeros(len(points), bool)
        first[np.searchsorted(at, ends[:-1][ends[1:] > ends[:-1]])] = True
        cuts = at[np.flatnonzero(self.splitter.starts(points, first))]
        if self.seen.held > CACHED_BYTES:
            self.seen = Seen(self.seen.merger)
        bounds = np.append(cuts, len(data)).tolist()
        pieces = [raw[a:b] for a, b in zip(bounds, bounds[1:])]
        self.seen.add(list(set(pieces).difference(self.seen)))
        numbers = np.fromiter(map(self.seen.__getitem__, pieces), np.int64, len(pieces))
        ids, stops = gathered(self.seen.ids, self.seen.ends, numbers)
        return ids, np.append(0, stops)[np.searchsorted(cuts, ends[1:])]

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all tokens, and where each token ends."""
        return gathered(self.token_bytes, self.token_ends, ids)


def encode(docs: DataFrame, vocabulary: bytes, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` and ``ends``: token ids, and the byte of the text at which each token ends."""
    fields = [StructField("ids", ArrayType(IntegerType(), False)), StructField("ends", ArrayType(LongType(), False))]

    def work():
        model = ByteBpe(vocabulary)

        def run(columns):
            ids, stops = model.encode(*common.utf8(columns[0]))
            ends = model.decode(ids)[1]
            stops = np.append(0, stops)
            ends = ends - np.repeat(np.append(0, ends)[stops[:-1]], np.diff(stops))
            offsets = pa.array(stops, pa.int32())
            return [pa.ListArray.from_arrays(offsets, pa.array(x)).cast(pa.list_(pa.field("element", t, False))) for x, t in ((ids, pa.int32()), (ends, pa.int64()))]

        return run

    return common.add_columns(docs, [text], fields, work, TEXT_BYTES)


def decode(tokens: DataFrame, vocabulary: bytes, ids: str = "ids") -> DataFrame:
    """``tokens`` with ``decoded``: the bytes of the tokens ``ids``, null for null."""

    def run(batches):
        model = ByteBpe(vocabulary)
        for batch in batches:
            values = [None if x is None else model.decode(np.array(x, np.int64))[0].tobytes() for x in batch.column("_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(values, pa.binary())], names=[*batch.schema.names[:-1], "decoded"])

    kept = [c for c in tokens.columns if c.lower() != "decoded"]
    schema = tokens.select(*kept).schema.add("decoded", BinaryType())
    return tokens.select(*kept, tokens[ids].alias("_ids")).mapInArrow(run, schema)


def round_trip(docs: DataFrame, vocabulary: bytes, text: str = "text", with_ids: bool = False) -> DataFrame:
    """``docs`` with ``n_tokens`` and the digests of the ids and of the bytes decoded from them, in one pass.

    ``ids_sha256`` is over the ids as little-endian unsigned 32-bit integers. ``with_ids`` adds the ``ids`` themselves.
    """
    fields = [StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())]
    if with_ids:
        fields.append(StructField("ids", ArrayType(IntegerType(), False)))

    def work():
        model = ByteBpe(vocabulary)

        def run(columns):
            ids, stops = model.encode(*common.utf8(columns[0]))
            data, ends = model.decode(ids)
            stops = np.append(0, stops)
            ends = np.append(0, ends)[stops]
            words, content = memoryview(ids.astype("<u4").tobytes()), memoryview(data.tobytes())
            made = [
                pa.array(np.diff(stops), pa.int64()),
                pa.array([hashlib.sha256(words[4 * a : 4 * b]).hexdigest() for a, b in zip(stops[:-1], stops[1:])], pa.string()),
                pa.array([hashlib.sha256(content[a:b]).hexdigest() for a, b in zip(ends[:-1], ends[1:])], pa.string()),
            ]
            if with_ids:
                made.append(pa.ListArray.from_arrays(pa.array(stops, pa.int32()), pa.array(ids)).cast(pa.list_(pa.field("element", pa.int32(), False))))
            return made

        return run

    return common.add_columns(docs, [text], fields, work, TEXT_BYTES)
