"""Scale check: the reports over an N-times mart derived from the test tables.

Every mart table is replicated N times (``explode(sequence(0, N-1))``, no
join) with the session and user keys suffixed by the copy number, so the
copies never join each other. Then for every report:

* time at 1x and Nx (median of ``--runs``), to see how the plans scale;
* exact invariant: each sum / distinct count at Nx is N times the 1x value
  (copies are disjoint), per output row.

Usage: python scripts/scale_check.py [sf_dir] [N] [--runs R] [--markdown out.md]
"""

from __future__ import annotations

import math
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from trafficlens.params import ReportParams  # noqa: E402
from trafficlens.plans.reports import REPORTS  # noqa: E402
from trafficlens.session import build_session, scratch_path  # noqa: E402
from trafficlens.sources import fixtures  # noqa: E402
from trafficlens.sources.mart import Mart  # noqa: E402

# Key columns per table that identify sessions / users (suffixed per copy).
KEYS = {
    "sessions": ("session_id", "user_id"),
    "raw_events": ("dimension4",),
    "page_views": ("dimension4",),
    "users_dim": ("dimension1",),
    "traffic": ("dimension1",),
    "costs": (),
    "banners": (),
}
# Output columns that are keys (compared as-is); every other numeric column scales by N.
KEY_COLS = {"week", "isoweek", "city", "eventlabel", "cpc_type", "eventaction", "month", "start_week",
            "CITY", "first_dt", "year", "product", "action_type", "card_serp"}


def replicate(frames: dict, n: int) -> dict:
    out = {}
    for name, df in frames.items():
        copies = df.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
        for k in KEYS[name]:
            copies = copies.withColumn(k, F.when(F.col(k).isNotNull(),
                                                 F.concat(F.col(k), F.lit("#"), F.col("_copy").cast("string"))))
        out[name] = copies.drop("_copy")
    return out


def timed(df_fn, runs: int) -> float:
    df_fn().write.format("noop").mode("overwrite").save()
    times = []
    for _ in range(runs):
        t = time.perf_counter()
        df_fn().write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - t)
    return statistics.median(times)


def keyed(df):
    keys = [c for c in df.columns if c in KEY_COLS]
    vals = [c for c in df.columns if c not in KEY_COLS]
    return {tuple(r[k] for k in keys): tuple(r[v] for v in vals) for r in df.collect()}, vals


def same_scaled(a: dict, b: dict, n: int) -> bool:
    """Every value of ``b`` is ``n`` times the one of ``a`` (doubles to 1e-12)."""
    if a.keys() != b.keys():
        return False
    for key, row in a.items():
        for x, y in zip(row, b[key]):
            if x is None or y is None:
                if x is not y:
                    return False
            elif isinstance(x, float) or isinstance(y, float):
                if not math.isclose(x * n, y, rel_tol=1e-12):
                    return False
            elif x * n != y:
                return False
    return True


def main():
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    sf_dir = args[0] if args else "/root/testdata/sf0.1"
    n = int(args[1]) if len(args) > 1 else 10
    runs = int(sys.argv[sys.argv.index("--runs") + 1]) if "--runs" in sys.argv else 3
    spark = build_session("local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    base = fixtures.derive_tables(spark, sf_dir)
    m1 = Mart.written(spark, base, scratch_path(spark, "mart-1x"))
    mn = Mart.written(spark, replicate({k: m1.table(k) for k in base}, n), scratch_path(spark, f"mart-{n}x"))
    p = ReportParams.for_testdata()
    lines = []
    for name, fn in REPORTS.items():
        t1 = timed(lambda: fn(m1, p), runs)
        tn = timed(lambda: fn(mn, p), runs)
        # R10 is positional, but the copies share every week, so its rows line
        # up by week as well.
        a, _ = keyed(fn(m1, p))
        b, _ = keyed(fn(mn, p))
        ok = "exact x%d" % n if same_scaled(a, b, n) else "MISMATCH"
        lines.append((name, t1, tn, ok))
        print(f"{name:30s} 1x {t1:6.3f}s  {n}x {tn:6.3f}s  ratio {tn / t1:5.2f}  {ok}", flush=True)
    if "--markdown" in sys.argv:
        path = sys.argv[sys.argv.index("--markdown") + 1]
        with open(path, "w") as fh:
            fh.write(f"# Scale check: {os.path.basename(sf_dir)} mart vs the same mart replicated {n}x\n\n")
            fh.write("Generated by `scripts/scale_check.py` on local[8] (median of "
                     f"{runs} runs, noop sink). Copies have disjoint session/user keys, so every sum and "
                     f"distinct count must be exactly {n}x the 1x value per output row (DOUBLE costs to a relative 1e-12).\n\n")
            fh.write(f"| report | 1x s | {n}x s | time ratio | values |\n| --- | --- | --- | --- | --- |\n")
            for name, t1, tn, ok in lines:
                fh.write(f"| {name} | {t1:.3f} | {tn:.3f} | {tn / t1:.2f} | {ok} |\n")
    spark.stop()


if __name__ == "__main__":
    main()
