"""Headline queries on the driver's tables. Prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from bindery.session import local_session  # noqa: E402
from workload import QUERIES  # noqa: E402

HEADLINE = [
    "boundwith_lookup", "lookup_enrich", "lookup_shape", "apply_changes", "stream_apply", "overlap_replay", "latest_change",
    "harvest_window", "classify_batch", "state_upsert", "split_balanced", "split_whole", "ledger_append", "prune_status",
    "ledger_remaining", "newest_batch_files", "key_rewrites", "empty_dirs", "records_per_file", "keyword_split",
    "url_encode_latin1", "subfield_select", "person_fields", "xoai_to_marc", "marcxml_roundtrip",
]
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def seconds(spark, name: str, sf_dir: str) -> float:
    """One run, results computed in full and thrown away."""
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def shuffled(spark) -> int:
    """Bytes written to shuffles so far."""
    executors = spark.sparkContext._jsc.sc().statusStore().executorList(True)
    return sum(executors.apply(i).totalShuffleWrite() for i in range(executors.size()))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    times = {}
    for name in HEADLINE:
        before = shuffled(spark)
        seconds(spark, name, sf_dir)  # compile and warm caches
        if os.environ.get("BENCH_DETAIL"):
            moved, rows = shuffled(spark) - before, QUERIES[name](spark, sf_dir).count()
            print(f"{name}: {rows} rows, {moved} bytes shuffled", file=sys.stderr, flush=True)
        times[name] = round(statistics.median(seconds(spark, name, sf_dir) for _ in range(RUNS)), 3)
    sf = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
