"""Main text of web pages by differencing with the page whose URL is nearest.

A page becomes lines, one for each block of text, each with what its elements say about it: dropped (inside menus, forms,
scripts, adverts and so on), article (inside an article or main element) or plain. Pages are put in the order of host and
path, over all tasks; of its two neighbours there a page is paired with the one of its host whose path shares the longer
beginning. The lines of both are aligned by their longest common subsequence, and lines that both have are deleted: what a
site repeats from page to page is not a page's own text.

Two exceptions keep results right. Lines that the page itself marks as its article stay even if shared, since articles are
copied too; if a page marks an article, plain lines outside of it go. And a pair that shares all plain lines is a copy, of
which nothing is deleted.

Null and empty pages have an empty text. Pages are read whole. Null URLs come first, with an empty host. Repeated rows give
repeated results. An empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
import sys
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField

from bindery.llm import common
from bindery.llm.neighbours import in_order

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""", re.S)
RAW = frozenset("script style textarea title noscript template iframe svg math xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q ruby s samp small span strike strong sub sup "
    "time tt u var wbr".split()
)
DROPPED = frozenset("head nav footer aside form button select dialog menu object canvas audio video".split())
ARTICLE = frozenset("article main".split())
# Words of class, id or role that mark what isn't main text.
HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo menu nav navbar navigation breadcrumb breadcrumbs sidebar "
    "footer masthead cookie cookies consent gdpr notice alert popup modal newsletter subscribe subscription signup share sharing social "
    "related comments comment commentlist disqus respond replies widget toolbar pagination pager login search".split()
)
PAGE_HEADS = frozenset("header head top".split())
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)


def hinted(attributes: str, inside: bool) -> bool:
    if not attributes:
        return False
    words = {w for _, value in ATTRIBUTE.findall(attributes) for w in re.split(r"[^a-z]+", value.lower())}
    return not HINTS.isdisjoint(words) or (not inside and not PAGE_HEADS.isdisjoint(words)) or HIDDEN.search(attributes) is not None


def lines_of(page: str | None) -> list[tuple[str, str]]:
    """(kind, text) of each block; kind is d (dropped), a (article) or p (plain)."""
    page = page or ""
    out: list[tuple[str, str]] = []
    held: list[str] = []
    stack: list[tuple[str, str]] = []  # open elements that matter: name, kind
    kind = "p"

    def end_block():
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            held.clear()
            if text:
                out.append((kind, text))

    at = 0
    while (m := TAG.search(page, at)) is not None:
        if m.start() > at:
            held.append(page[at : m.start()])
        at = m.end()
        if m.group(2) is None:
            continue
        name, closing = m.group(2).lower(), bool(m.group(1))
        if name not in INLINE:
            end_block()
        if name in RAW and not closing:
            stop = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
            at = stop.end() if stop else len(page)
            continue
        if name in VOID:
            continue
        if closing:
            found = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if found is not None:
                end_block()
                del stack[found:]
        else:
            if name == "body":
                stack = [s for s in stack if s[0] != "head"]  # a head that was never closed
            if name in ("p", "li") and stack and stack[-1][0] == name:
                stack.pop()
            inside = any(s[1] == "a" for s in stack)
            if name in DROPPED or name == "header" and not inside or hinted(m.group(3), inside):
                own = "d"
            elif name in ARTICLE or 'role="main"' in m.group(3):
                own = "a"
            else:
                own = ""
            if own or name not in INLINE and name not in ("p", "li") or name in {s[0] for s in stack if s[1]}:
                if own:
                    end_block()
                stack.append((name, own))
        kinds = {s[1] for s in stack}
        kind = "d" if "d" in kinds else "a" if "a" in kinds else "p"
    held.append(page[at:])
    end_block()
    return out


def shared(a: list[str], b: list[str]) -> list[bool]:
    """Which lines of ``a`` are in a longest common subsequence with ``b``.

    Equal ends are cut off; between them rows of the table are bits of one number each.
    """
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    stop = 0
    while stop < min(len(a), len(b)) - start and a[-1 - stop] == b[-1 - stop]:
        stop += 1
    out = [True] * start + [False] * (len(a) - start - stop) + [True] * stop
    left, right = a[start : len(a) - stop], b[start : len(b) - stop]
    places: dict[str, int] = {}
    for j, line in enumerate(right):
        places[line] = places.get(line, 0) | 1 << j
    if not places or places.keys().isdisjoint(left):
        return out
    full = (1 << len(right)) - 1
    rows = [full]  # bit j of row i is 0 where the length for the first i and j + 1 lines exceeds that for j
    row = full
    for line in left:
        found = row & places.get(line, 0)
        row = ((row + found) | (row - found)) & full
        rows.append(row)
    i, j = len(left), len(right)
    while i and j:
        if rows[i] >> (j - 1) & 1:
            j -= 1
        elif not rows[i - 1] >> (j - 1) & 1:
            i -= 1
        else:
            i, j = i - 1, j - 1
            out[start + i] = True
    return out


def main_text(kinds: list[str], lines: list[str], other_kinds: list[str] | None, other_lines: list[str] | None) -> str:
    """Main text of a page, given its lines and those of the page paired with it, if any."""
    article = "a" in kinds
    drop = [False] * len(lines)
    if other_lines is not None:
        drop = shared(lines, other_lines)
        plain = [d for d, k in zip(drop, kinds) if k == "p"]
        if plain and all(plain):
            drop = [False] * len(lines)
    kept = [t for k, t, d in zip(kinds, lines, drop) if k == "a" or (k == "p" and not article and not d)]
    return " ".join(kept)


def place_of(url: str | None) -> tuple[str, str]:
    """Host and path of a URL; what can't be taken apart is all path."""
    try:
        parts = urlsplit(url or "")
        return (parts.hostname or "").removeprefix("www."), parts.path
    except ValueError:
        return "", url or ""


def near(a: tuple[str, str], b: tuple[str, str]) -> int:
    """Characters that the paths share from the beginning; -1 on different hosts."""
    if a[0] != b[0]:
        return -1
    n = 0
    for x, y in zip(a[1], b[1]):
        if x != y:
            break
        n += 1
    return n


def extract(pages: DataFrame, page: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """(page_id, url, text) of every page, text empty if there is none."""
    frame = pages.select(F.col(page).alias("page_id"), F.col(url).alias("url"), F.col(source).alias("html"))
    place = [StructField("host", StringType()), StructField("path", StringType())]
    read = [StructField("kinds", StringType()), StructField("lines", ArrayType(StringType()))]

    def locate():
        def run(columns):
            places = [place_of(x) for x in columns[0].to_pylist()]
            return [pa.array([p[i] for p in places], pa.string()) for i in (0, 1)]

        return run

    def parse():
        where = locate()

        def run(columns):
            lines = [lines_of(x) for x in columns[0].to_pylist()]
            return where(columns[1:]) + [pa.array(["".join(k for k, _ in x) for x in lines], pa.string()), pa.array([[t for _, t in x] for x in lines], pa.list_(pa.string()))]

        return run

    # The order needs no page: it is found from URLs and ids, then each page is parsed once. Pages of one URL may be many, so
    # the id is part of the order.
    keys = ["host", "path", "of", "page"]
    parts_of = {"of": F.coalesce("url", F.lit("")), "page": F.coalesce(F.col("page_id").cast("string"), F.lit(""))}
    only = common.add_columns(frame.select("page_id", "url"), ["url"], place, locate).withColumns(parts_of)
    parsed = common.add_columns(frame, ["html", "url"], place + read, parse).drop("html").withColumns(parts_of)
    ordered = in_order(parsed, keys, ["page_id"], before=True, only=only)

    def work(batches):
        previous = waiting = None  # rows: id, url, place, kinds, lines, ghost, bucket

        def result(row, before, after):
            best = None
            for other in (after, before):
                if other is not None and other[6] == row[6]:
                    distance = near(row[2], other[2])
                    if distance >= 0 and (best is None or distance > best[0]):
                        best = (distance, other)
            other = best[1] if best else None
            return (row[0], row[1], main_text(list(row[3]), row[4], list(other[3]) if other else None, other[4] if other else None))

        def batch_of(rows):
            columns = list(zip(*rows)) or [[], [], []]
            return pa.RecordBatch.from_arrays([pa.array(columns[0], kind), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.string())], names=["page_id", "url", "text"])

        kind = None
        for batch in batches:
            kind, out = batch.schema.field("page_id").type, []
            for values in zip(*[batch.column(c).to_pylist() for c in ("page_id", "url", "host", "path", "kinds", "lines", "_ghost", "_bucket")]):
                row = (values[0], values[1], (values[2], values[3]), values[4], values[5], values[6], values[7])
                if waiting is not None:
                    if waiting[5] == 0:
                        out.append(result(waiting, previous, row))
                    previous = waiting
                waiting = row
            yield batch_of(out)
        if waiting is not None and waiting[5] == 0:
            yield batch_of([result(waiting, previous, None)])

    columns = ("page_id", "url", "host", "path", "kinds", "lines", "_ghost", "_bucket")
    return ordered.select(*columns).mapInArrow(work, f"page_id {dict(pages.dtypes)[page]}, url string, text string")
