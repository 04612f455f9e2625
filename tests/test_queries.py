"""Every registered query against its SQL twin, and what its plan may contain."""

import contextlib
import io
import re

import pytest

from compare import compare, oracle
from workload import QUERIES, SQL

# Python workers unpack archives; everything else stays in the JVM.
PYTHON_ALLOWED = {"archive_roundtrip", "streamed_archives"}


@pytest.fixture(scope="module")
def connection(sf_dir):
    return oracle(sf_dir)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, connection, sf_dir, name):
    assert compare(spark, connection, name, QUERIES[name], SQL[name], sf_dir) is None


@pytest.mark.parametrize("name", list(QUERIES))
def test_plan(spark, sf_dir, name):
    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        QUERIES[name](spark, sf_dir).explain()
    plan = shown.getvalue()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # A window whose rows come from one exchange without keys would run in one task.
    assert not re.search(r"Window .*\n[^\n]*Sort[^\n]*\n[^\n]*SinglePartition", plan)
    assert not re.search(r"collect_(list|set)", plan)
    if name not in PYTHON_ALLOWED:
        assert not re.search(r"Python|Pandas|MapInArrow", plan)


def test_entry(spark):
    import __spark_entry__ as driver

    assert driver.entry(spark).count() > 0
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_filters_reach_the_scan(spark, sf_dir):
    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        QUERIES["harvest_window"](spark, sf_dir).explain()
    assert "GreaterThanOrEqual(ts" in shown.getvalue() and "LessThanOrEqual(ts" in shown.getvalue()
    assert "props" not in shown.getvalue()
