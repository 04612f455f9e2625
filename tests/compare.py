"""Run queries against their SQL twins in DuckDB and compare rows as multisets."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def rows_of(columns: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(row[i] for i in order) for row in rows)


def compare(spark, connection, name: str, query, sql: str, sf_dir: str) -> str | None:
    """None when equal, else what differs."""
    frame = query(spark, sf_dir)
    got_columns, got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    result = connection.execute(sql)
    types = {d[0]: str(d[1]) for d in result.description}
    want_columns, want = rows_of([d[0] for d in result.description], result.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} vs {want_columns}"
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
    odd = {f: (t, types[f]) for f, t in frame.dtypes if kinds.get(t) != types[f] and not (kinds.get(t), types[f]) == ("VARCHAR", "STRING")}
    if got != want:
        extra, missing = list((got - want).items())[:2], list((want - got).items())[:2]
        return f"{sum(got.values())} vs {sum(want.values())} rows; only ours {str(extra)[:700]}; only SQL {str(missing)[:700]}; types {odd}"
    return f"types {odd}" if odd else ("no rows" if not got else None)


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from bindery.session import local_session
    from workload import QUERIES, SQL

    sf_dir = f"/root/testdata/{sys.argv[1]}"
    chosen = sys.argv[2:] or list(QUERIES)
    spark, connection = local_session(), oracle(sf_dir)
    for name in chosen:
        started = time.time()
        try:
            found = compare(spark, connection, name, QUERIES[name], SQL[name], sf_dir) if name in SQL else f"rows {QUERIES[name](spark, sf_dir).count()}"
        except Exception as error:  # report and go on
            found = f"ERROR {type(error).__name__} {str(error)[:900]}"
        print(f"{name:24s} {time.time() - started:6.2f}s {'ok' if found is None else found}", flush=True)
