"""String functions with XPath semantics, which differ from the like-named Spark functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# White space in XML text; leading-article lengths of titles.
XML_SPACE = " \t\r\n"
SKIPPED_ARTICLES = {"The ": 4, "An ": 3, "A ": 2}


def substring_before(text: Column, mark: str) -> Column:
    """Text before the first ``mark``; empty when it is absent."""
    return F.when(F.instr(text, mark) > 0, F.substring_index(text, mark, 1)).otherwise("")


def substring_after(text: Column, mark: str) -> Column:
    """Text after the first ``mark``; empty when it is absent."""
    at = F.instr(text, mark)
    return F.when(at > 0, F.substr(text, at + F.lit(len(mark)))).otherwise("")


def xp_substring(text: Column, start: Column | int, length: Column | int | None = None) -> Column:
    """One-based substring. A start below one shortens the length; it does not count from the end."""
    first = _int(start)
    begin = F.greatest(first, F.lit(1))
    if length is None:
        return F.substr(text, begin)
    return F.substr(text, begin, F.greatest(first + _int(length) - begin, F.lit(0)))


def _int(value: Column | int) -> Column:
    return F.lit(value) if isinstance(value, int) else value


def normalize_space(text: Column) -> Column:
    """Trim and collapse runs of XML white space. Single spaces, the usual case, are not rewritten."""
    return F.trim(F.regexp_replace(text, f"[{XML_SPACE}]{{2,}}|[{XML_SPACE.strip(' ')}]", " "))


def is_digit_at(text: Column, position: Column | int) -> Column:
    """Whether the one character at ``position`` is an ASCII digit."""
    return xp_substring(text, position, 1).rlike("^[0-9]$")


def translate(text: Column, source: str, target: str) -> Column:
    """Map characters one to one; characters of ``source`` without a partner are removed."""
    return F.translate(text, source, target)


def title_skip(title: Column) -> Column:
    """Number of leading characters a sort ignores, by case-sensitive English article."""
    result = F
    for article, width in SKIPPED_ARTICLES.items():
        result = result.when(F.startswith(title, F.lit(article)), F.lit(width))
    return result.otherwise(F.lit(0))


def repeat_char(count: Column, char: str = " ") -> Column:
    """``char`` repeated; nothing for zero or less."""
    return F.repeat(F.lit(char), F.greatest(count.cast("int"), F.lit(0)))


def short_date(day: Column) -> Column:
    """Date as ``yyMMdd``. The run date is passed in, so reruns give equal rows."""
    return F.date_format(day, "yyMMdd")


def split_keywords(text: Column) -> Column:
    """Comma-separated tokens as an array.

    The first token is raw. Everything behind the first comma is white-space normalised, and again
    after every further comma, so later tokens lose leading space and inner runs, the last one also
    its trailing space, and a trailing comma leaves an empty token. Only the part behind the first
    comma is rewritten, in one pass over the whole text.
    """
    rest = substring_after(text, ",")
    later = F.split(normalize_space(rest), ",")
    later = F.transform(later, lambda token: F.ltrim(token))
    several = F.concat(F.array(substring_before(text, ",")), later)
    return F.when(F.instr(text, ",") > 0, several).otherwise(F.array(text))
