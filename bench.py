"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the cores, BENCH_RUNS the warm runs per query
(their median counts). Results go to Spark's noop sink, so nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from crawlfold.session import local_session  # noqa: E402
from driver.queries import ALL  # noqa: E402

HEADLINE = (
    "seed_urls", "lease_feed", "listing_extract", "detail_extract", "page_verdict", "keywords_join",
    "completeness_codes", "completeness_by_code", "upsert_merge", "dup_listing_count", "claim_batch",
    "lock_state", "requeue", "pool_state", "ban_streak_running", "first_death", "pool_report",
    "balanced_assignment", "lease_history", "listing_depth", "stream_extract", "stream_upsert",
    "stream_pool",
)


def seconds(spark, sf: str, name: str) -> float:
    start = time.perf_counter()
    ALL[name](spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")), "crawlfold-bench")
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        seconds(spark, sf, name)
        times[name] = round(statistics.median(seconds(spark, sf, name) for _ in range(runs)), 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "total time of the headline queries, median warm run each",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(sf).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
