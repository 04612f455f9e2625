"""Values held as JSON or list text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from bindery.functions.keys import is_blank


def num_found(response: Column) -> Column:
    """Hit count in a search response; zero when it cannot be read."""
    return F.coalesce(F.get_json_object(response, "$.response.numFound").try_cast("long"), F.lit(0).cast("long"))


def failure_reason(body: Column, status: Column, reason: Column) -> Column:
    """The error message of a response, or its status line."""
    message = F.get_json_object(body, "$.error.msg")
    empty = F.lit("")
    return F.coalesce(message, F.concat(F.coalesce(status.cast("string"), empty), F.lit(":"), F.coalesce(reason, empty)))


def parse_list(text: Column) -> Column:
    """A list literal as an array. Null and blank text are the empty list; other text gives null."""
    parsed = F.from_json(text, "array<string>", {"allowSingleQuotes": "true"})
    return F.when(is_blank(text), F.array().cast("array<string>")).otherwise(parsed)
