"""Quality rules from a table of thresholds, compiled into one projection of built-in expressions.

Each row of the table bounds the ratio of two measures of a text: rule, numerator, denominator, least and most in percent
(either may be open). A rule holds where 100 * numerator lies within least and most times the denominator, so no division and
no rounding takes part, and a text whose denominator is zero passes. The measures are counted by one expression, whose words,
lines and stop words are made once for each text; a second projection compares them with the table. There is no Python worker
and no shuffle.

Words in repeated windows are found by sorting the hashes of a text's windows, with their places, and by adding up how many
words each repeated window covers beyond the one before. Two windows with the same 64-bit hash count as equal.

The stop words are those of English, French, German and Spanish: for other languages give others, or a table without that rule.

Null and empty texts have no words and fail. Rows that repeat are judged each. Texts are read whole; a text's windows are in
memory at once, a few dozen bytes for each word. An empty table gives an empty result. ``judged`` and ``keep`` leave other
columns as they are; where one has the name of a column that ``judged`` adds, it is replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PLACE_BITS = 24
SPACE = r"[\x20\x09-\x0D]+"
# Frequent function words of four languages.
STOP_WORDS = (
    "a an and are as at be but by for from had has have he her his i in is it its not of on or she that the their they this to "
    "was we were which with you "
    "au aux avec ce ces dans de des du elle en est et eux il je la le les leur lui ma mais me même mes moi mon ne nos notre nous "
    "on ou par pas pour qu que qui sa se ses son sur ta te tes toi ton tu un une vos votre vous "
    "aber als am an auch auf aus bei bin bis da das dem den der des die dir doch du ein eine einem einen einer er es für hat ich "
    "ihm ihn ihr im in ist ja mein mich mir mit nach nicht noch nur ob oder sein sich sie sind so um und uns vom von vor war "
    "was wie wir zu zum zur "
    "al algo con como de del el ella en entre era es esa ese eso esta este fue ha hasta hay la las lo los más me mi muy nada ni no "
    "o para pero por porque que se si sin sobre su sus también te tiene todo tu un una uno y ya yo"
).split()

Threshold = tuple[str, str, str, int | None, int | None]  # rule, numerator, denominator, least and most in percent

BASE: tuple[Threshold, ...] = (
    ("few_words", "n_words", "one", 5_000, None),
    ("repeated_windows", "n_repeat_words", "n_words", None, 50),
)
RULES: tuple[Threshold, ...] = (
    ("word_length", "word_chars", "n_words", 250, 1_200),
    ("symbols", "n_symbols", "n_words", None, 10),
    ("stop_words", "n_stop_words", "n_words", 4, None),
    ("duplicate_lines", "n_dup_lines", "n_lines", None, 50),
    ("shouted_lines", "n_shouted", "n_lines", None, 50),
)


def with_value(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _covered(places: Column) -> Column:
    """Words in windows of three that begin at these places, which are in order."""
    steps = F.zip_with(places, F.slice(places, 2, F.greatest(F.size(places), F.lit(1))), lambda p, q: F.least(F.coalesce(q - p, F.lit(3)), F.lit(3)))
    return F.aggregate(steps, F.lit(0), lambda total, n: total + n)


def _equal_neighbours(items: Column, key: Callable[[Column], Column]) -> Column:
    """Those items of a sorted array whose key the item before or after has, too."""
    return with_value(items, lambda s: F.filter(s, lambda x, i: (key(x) == key(F.get(s, i + 1))) | (key(x) == key(F.get(s, i - 1)))))


def repeat_words(words: Column) -> Column:
    """Words in windows of three that the text has twice or more.

    Numbers made of a hash's upper bits and a place sort faster than pairs. They leave few windows whose bits meet; only
    these are sorted by their whole hash. A text with more places than the lower bits hold has all of them sorted so.
    """
    hashed = lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
    last = F.size(words) - 3
    starts = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<int>"))
    packed = F.sort_array(F.transform(starts, lambda i: hashed(i).bitwiseAND(F.lit(-(1 << PLACE_BITS))).bitwiseOR(i.cast("long"))))
    upper = lambda x: F.shiftright(x, PLACE_BITS)
    meeting = F.transform(_equal_neighbours(packed, upper), lambda x: x.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).cast("int"))
    chosen = F.when(last < 1 << PLACE_BITS, meeting).otherwise(starts)
    windows = F.sort_array(F.transform(chosen, lambda i: F.struct(hashed(i).alias("h"), i.alias("i"))))
    again = _equal_neighbours(windows, lambda x: x["h"])
    return with_value(F.sort_array(F.transform(again, lambda x: x["i"])), _covered)


def measures(text: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """What the rules compare, as one struct of longs."""
    text = F.coalesce(text, F.lit(""))
    letters = F.length(F.regexp_replace(text, SPACE, ""))
    symbols = F.length(F.regexp_replace(text, "[^#*$%&|<>]+", ""))
    words = F.array_remove(F.split(text, SPACE), "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    stops = lambda ws: F.size(F.filter(ws, lambda w: F.lower(w).isin(*stop_words)))
    shouted = lambda ls: F.size(F.filter(ls, lambda line: line.rlike(r"\p{Lu}") & ~line.rlike(r"\p{Ll}")))
    count = lambda ws, ls: {
        "one": F.lit(1), "n_words": F.size(ws), "word_chars": letters, "n_symbols": symbols, "n_lines": F.size(ls),
        "n_dup_lines": F.size(ls) - F.size(F.array_distinct(ls)), "n_shouted": shouted(ls), "n_stop_words": stops(ws), "n_repeat_words": repeat_words(ws),
    }
    made = lambda ws, ls: F.struct(*[c.cast("long").alias(n) for n, c in count(ws, ls).items()])
    return with_value(words, lambda ws: with_value(lines, lambda ls: made(ws, ls)))


def fails(table: Sequence[Threshold], of: Callable[[str], Column]) -> Column:
    """Names of the rules of the table that a text fails; ``of`` gives the column of a measure."""
    broken = []
    for rule, above, below, least, most in table:
        ratio, whole = of(above) * 100, of(below)
        bounds = [ratio < whole * n for n in (least,) if n is not None] + [ratio > whole * n for n in (most,) if n is not None]
        broken += [F.when(bound, F.lit(rule)) for bound in bounds]
    return F.array_compact(F.array(*broken))


def judged(docs: DataFrame, text: str = "text", rules: Sequence[Threshold] = RULES, base: Sequence[Threshold] = BASE, stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """Adds the measures, ``base_failed``, ``failed`` (names of the failed rules, base ones first) and ``kept``."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_shouted", "n_stop_words"]
    added = {*names, "base_failed", "failed", "kept"}
    counted = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), measures(F.col(f"`{text}`"), stop_words).alias("m"))
    kept = [F.col("row").getField(c).alias(c) for c in docs.columns if c.lower() not in added]
    of = lambda name: F.col("m").getField(name)
    by_base, by_rule = fails(base, of), fails(rules, of)
    return counted.select(
        *kept, *[of(n).alias(n) for n in names], (F.size(by_base) > 0).alias("base_failed"), F.concat(by_base, by_rule).alias("failed"),
        ((F.size(by_base) == 0) & (F.size(by_rule) == 0)).alias("kept"),
    )


def keep(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows that pass, with their own columns."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    out = judged(docs.select(row, F.col(f"`{text}`").alias("text")), "text", **options).where("kept")
    return out.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
