"""Headline-query benchmark.

Runs each headline query at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS]: one warm-up, then the median of $BENCH_REPEATS runs
(default 3; the two model-fitting queries run once after their warm-up).
Each run executes the whole plan into Spark's no-op sink, so nothing is
collected. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from kerbside.session import build_session  # noqa: E402
from kerbside.queries import QUERIES  # noqa: E402

HEADLINE = ["silver_listings", "market_impact", "diesel_devaluation", "impact_summary", "run_quality_checks",
            "stream_brand_feed", "segment_market", "price_model_metrics"]
HEAVY = {"segment_market", "price_model_metrics"}


def run_once(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus)
    times = {}
    for name in only or HEADLINE:
        run_once(spark, name, sf_dir)  # warm-up
        n = 1 if name in HEAVY else repeats
        times[name] = round(statistics.median(run_once(spark, name, sf_dir) for _ in range(n)), 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
