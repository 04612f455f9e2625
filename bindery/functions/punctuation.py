"""Stripping of cataloguing punctuation from either end of a value."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The punctuation sets.
TRAILING = ".:,;/ "
LEADING = ".:,;/[ "
TRAILING_CLOSE = ".:,;/] "


def chop_trailing(text: Column, marks: str = TRAILING) -> Column:
    """Drop every trailing character of ``marks``."""
    return F.rtrim(text, F.lit(marks))


def chop_leading(text: Column, marks: str = LEADING) -> Column:
    """Drop every leading character of ``marks``."""
    return F.ltrim(text, F.lit(marks))


def chop_trailing_close(text: Column, marks: str = TRAILING_CLOSE) -> Column:
    """Drop every trailing character of ``marks``, which also holds the closing bracket."""
    return F.rtrim(text, F.lit(marks))
