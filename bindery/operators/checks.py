"""Expectations. Each returns the violating rows; ``enforce`` stops a job on the first of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from bindery.functions.keys import is_blank
from bindery.operators.ledger import FAILED


class ExpectationError(Exception):
    """Raised when rows violate an expectation."""


def _violations(rows: DataFrame, bad: Column, rule: str, subject: Column, detail: Column) -> DataFrame:
    return rows.filter(bad).select(
        F.lit(rule).alias("rule"), subject.cast("string").alias("subject"), detail.alias("detail")
    )


def expect_not_blank(rows: DataFrame, column: str, subject: str) -> DataFrame:
    value = F.col(column)
    return _violations(rows, is_blank(value), "not_blank", F.col(subject), F.coalesce(value, F.lit("null")))


def expect_different(rows: DataFrame, left: str, right: str, subject: str) -> DataFrame:
    """Two values must differ, unless both are null."""
    return _violations(rows, F.col(left) == F.col(right), "different", F.col(subject), F.col(left))


def expect_rows(counts: DataFrame, count: str, subject: str) -> DataFrame:
    """Every subject needs at least one row."""
    return _violations(
        counts, F.coalesce(F.col(count), F.lit(0)) == 0, "rows", F.col(subject), F.lit("no rows")
    )


def expect_no_failures(processed: DataFrame, subject: str = "name") -> DataFrame:
    return _violations(processed, F.col("status") == FAILED, "no_failures", F.col(subject), F.col("reason"))


def enforce(violations: DataFrame) -> None:
    """Raise if there is a violation. Fetches one row."""
    first = violations.first()
    if first is not None:
        raise ExpectationError(f"{first['rule']}: {first['subject']} ({first['detail']})")
