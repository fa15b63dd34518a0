"""Time the headline queries; prints one JSON line.

Each query runs once to warm up and then BENCH_RUNS times; its number is the
median. Results go to a sink that discards them, so every row is computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tremorline.plans.queries import QUERIES  # noqa: E402
from tremorline.session import local_session  # noqa: E402

HEADLINE = [
    "normalize_features",
    "upsert_raw",
    "scan_raw",
    "count_by_hour",
    "avg_magnitude_by_day",
    "sql_count_by_hour",
    "merge_hour_counts",
    "ingest_audit",
    "lookup_hour_counts",
    "stream_ingest",
    "hour_counts_from_documents",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    scratch = f"file://{tempfile.mkdtemp(prefix='tremorline-bench-')}"
    spark = local_session(cores, "tremorline-bench", "16g", scratch)

    def seconds(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    timings = {}
    for name in names:
        seconds(name)
        timings[name] = round(statistics.median(seconds(name) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_median_query_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
