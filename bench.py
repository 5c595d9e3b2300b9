"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is forced to completion with the ``noop`` sink (full execution,
nothing collected to the driver).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "q_daily_events",
    "q_user_activity",
    "q_hourly_recent",
    "dq_report",
    "profile_base",
    "dedup_latest",
    "group_sum",
    "join_broadcast",
    "join_left",
    "metric_histogram",
    "vt_merge",
    "vt_crud",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from tessera import plans
    from tessera.session import build_session

    spark = build_session(
        "tessera-bench",
        master=f"local[{cpus}]",
        conf={"spark.sql.shuffle.partitions": str(max(8, 2 * int(cpus))), "spark.driver.memory": "16g"},
    )
    # warm-up: JVM class loading and codegen caches, not timed
    plans.QUERIES["scan_parquet"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        t = time.perf_counter()
        plans.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
