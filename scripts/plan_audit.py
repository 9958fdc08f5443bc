"""Audit the physical plans of the reports as they run on a real mart.

Writes the derived test tables once as date-partitioned parquet (a mart like
production's, ``Mart.written``) under a fresh scratch folder, then for every report prints the
executed adaptive plan's shape: shuffles, joins, pushed filters, read schema,
Python evaluation. ``--no-broadcast`` plans as if no side fitted the broadcast
threshold (the 100 TB case).

Usage: python scripts/plan_audit.py [sf_dir] [--no-broadcast] [--markdown out.md]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from trafficlens.params import ReportParams  # noqa: E402
from trafficlens.plans.reports import REPORTS  # noqa: E402
from trafficlens.session import build_session, scratch_path  # noqa: E402
from trafficlens.sources import fixtures  # noqa: E402
from trafficlens.sources.mart import Mart  # noqa: E402

def materialize(spark, sf_dir: str) -> Mart:
    """The derived test tables written once in the production layout."""
    return Mart.written(spark, fixtures.derive_tables(spark, sf_dir), scratch_path(spark, "mart"))


def final_plan(plan: str) -> str:
    """The executed AQE plan prints the final and the initial plan; keep the final one."""
    return plan.split("== Initial Plan ==")[0]


def shape(plan: str) -> dict:
    plan = final_plan(plan)
    lines = plan.split("\n")
    return {
        "shuffles": sum(1 for ln in lines if re.search(r"\bExchange (hash|range|Single|Round)", ln)
                        and "Reused" not in ln),
        "reused": sum(1 for ln in lines if "ReusedExchange" in ln),
        "broadcasts": sum(1 for ln in lines if "BroadcastExchange" in ln),
        "joins": re.findall(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin|BroadcastNestedLoopJoin"
                            r"|CartesianProduct)", plan),
        "pushed": sorted(set(re.findall(r"PushedFilters: \[([^\]]*)\]", plan))),
        "partition_filters": sorted(set(re.findall(r"PartitionFilters: \[([^\]]*)\]", plan))),
        "read_schema": sorted(set(re.findall(r"ReadSchema: (struct<[^>]*>)", plan))),
        "python": bool(re.search(r"(BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas)", plan)),
        "skew_split": "skew" in plan.lower(),
    }


def main():
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    sf_dir = args[0] if args else "/root/testdata/sf0.1"
    extra = {"spark.sql.autoBroadcastJoinThreshold": "-1"} if "--no-broadcast" in sys.argv else {}
    spark = build_session("local[8]", shuffle_partitions=8, extra_conf=extra)
    spark.sparkContext.setLogLevel("ERROR")
    mart = materialize(spark, sf_dir)
    params = ReportParams.for_testdata()
    out = []
    for key, fn in REPORTS.items():
        df = fn(mart, params)
        df.collect()
        s = shape(df._jdf.queryExecution().executedPlan().toString())
        fmt = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        s["pushed"] = sorted(set(re.findall(r"PushedFilters: \[([^\]]*)\]", fmt)))
        s["partition_filters"] = sorted(set(re.findall(r"PartitionFilters: \[([^\]]*)\]", fmt)))
        s["read_schema"] = sorted(set(re.findall(r"ReadSchema: (struct<[^>]*>)", fmt)))
        out.append((key, s))
        print(f"{key:30s} shuffles={s['shuffles']:2d} reused={s['reused']} joins={s['joins']} "
              f"python={s['python']}")
    if "--markdown" in sys.argv:
        path = sys.argv[sys.argv.index("--markdown") + 1]
        with open(path, "w") as fh:
            mode = "no broadcast (every join shuffled)" if extra else "default thresholds, AQE on"
            fh.write(f"# Report plans over a date-partitioned parquet mart ({os.path.basename(sf_dir)}, {mode})\n\n")
            fh.write("Generated by `scripts/plan_audit.py`; executed adaptive plans.\n\n")
            fh.write("| report | shuffles | reused | joins | Python | scan filters pushed | partition filters |\n")
            fh.write("| --- | --- | --- | --- | --- | --- | --- |\n")
            for key, s in out:
                joins = ", ".join(f"{j}×{s['joins'].count(j)}" for j in sorted(set(s["joins"]))) or "—"
                pushed = "<br>".join(f"`{p}`" for p in s["pushed"] if p) or "—"
                parts = "<br>".join(f"`{p}`" for p in s["partition_filters"] if p) or "—"
                fh.write(f"| {key} | {s['shuffles']} | {s['reused']} | {joins} | {'yes' if s['python'] else 'no'} "
                         f"| {pushed} | {parts} |\n")
    spark.stop()


if __name__ == "__main__":
    main()
