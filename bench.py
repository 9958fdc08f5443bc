"""Benchmark: the published reports plus the incremental banner load.

Runs each headline query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1)
with ``local[$BENCH_CPUS]``: one warm-up, then the median of ``$BENCH_RUNS``
(default 5) executions into the ``noop`` sink (the whole result is computed,
nothing is collected). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from trafficlens.plans.catalog import queries  # noqa: E402
from trafficlens.session import build_session  # noqa: E402

HEADLINE = (
    "report_phone_clicks",
    "report_calls_by_campaign",
    "report_vas_by_action",
    "report_mortgage",
    "report_claims",
    "report_registrations",
    "report_registrations_section",
    "report_deal_combined",
    "report_monthly_users",
    "report_weekly_cost",
    "report_retention",
    "report_banners",
    "report_vas_by_city",
    "incremental_append",
)


def run_once(spark, key: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    df = queries()[key](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    spark = build_session(f"local[{cpus}]", app_name="trafficlens-bench", shuffle_partitions=int(cpus),
                          extra_conf={"spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    timings: dict[str, float] = {}
    for key in HEADLINE:
        run_once(spark, key, sf_dir)  # warm-up
        timings[key] = round(statistics.median(run_once(spark, key, sf_dir) for _ in range(runs)), 4)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({
        "metric": "report_suite_seconds",
        "value": round(sum(timings.values()), 4),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "runs": runs,
        "cpus": int(cpus),
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
