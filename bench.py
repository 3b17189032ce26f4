"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is run once to warm up and then timed; its whole result is computed and discarded.
"""

from __future__ import annotations

import json
import os
import time

from rollmark.plans.catalog import QUERIES
from rollmark.plans.session import local_session

HEADLINE = [
    "group_marks", "decode_props", "dedupe_events", "enrich_full", "validate_marks", "arbitrate_marks",
    "mark_admission", "latest_marks", "latest_non_null", "merge_latest", "conform_enriched",
    "history_by_month", "kafka_rows", "student_attendance", "teacher_attendance_pct",
    "stream_enrich", "stream_latest", "stream_arbitrate", "stream_settle",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.sparkContext.setLogLevel("ERROR")
    wanted = os.environ.get("BENCH_QUERIES")
    names = wanted.split(",") if wanted else HEADLINE

    def run(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    seconds = {}
    for name in names:
        run(name)
        seconds[name] = round(run(name), 3)
    print(json.dumps({
        "metric": "total seconds of the headline queries, warm",
        "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
