"""Command line: the reference's run, as two Spark jobs.

  python -m trafficlens load    --landing DIR --target PATH [--today D] [--default-start D] [--step N]
  python -m trafficlens publish --mart ROOT --out DIR [--testdata SF_DIR] [--calendar reference|testdata]

``load`` adds the landed report-API pages of every window that the target's ledger
wants (a repeated load replaces its dates). ``publish`` computes every
report over the mart (one parquet directory per table under ROOT, or the
tables derived from a test-data directory) and writes one CSV per destination.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficlens.params import ReportParams
from trafficlens.plans.registry import publish_all
from trafficlens.session import build_session
from trafficlens.sources.mart import Mart
from trafficlens.sources.report_api import current_pages, read_report_pages
from trafficlens.sources.schemas import LOADED_BANNERS
from trafficlens.streaming.incremental import newest_partition, stream_windows
from trafficlens.streaming.ledger import ledger_load, ledger_path


def landed_pages_for(spark: SparkSession, landing_dir: str):
    """``fetch_pages`` over a landing folder laid out by window start: the range
    of days prunes the folders, then the pages are matched to the exact windows
    (a semi-join on both bounds). A page that landed more than once counts once, by
    its newest landing."""
    def fetch(windows: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
        wanted = windows.select(F.col("window_start").cast("string").alias("startDate"),
                                F.col("window_end").cast("string").alias("endDate"))
        pages = read_report_pages(spark, landing_dir).where(
            F.col("startDate").between(first.isoformat(), last.isoformat()))
        return current_pages(pages.join(wanted, ["startDate", "endDate"], "left_semi"))
    return fetch


class IncompleteLoad(RuntimeError):
    pass


# Failing windows named in a load's report (all are counted).
NAMED_WINDOWS = 50
NAMED_RANGES = 5


def window_checks(statuses: list) -> dict:
    """Quality (S11) and completeness (S10) of the landed windows (``page_coverage``
    rows): the counts of all and the names of the first failing ones, with the rows
    they cover and the ranges of rows that are missing."""
    def lacking(s) -> str:
        text = f"{s.startDate}..{s.endDate} ({s.covered_rows}/{s.expected_rows})"
        if s.missing:
            text += " missing rows " + ", ".join(f"{r.first}-{r.stop - 1}" for r in s.missing[:NAMED_RANGES])
        if s.overlap_rows:
            text += f" overlapping {s.overlap_rows}"
        return text + (f" unplaced pages {s.unplaced}" if s.unplaced else "")

    sampled = [f"{s.startDate}..{s.endDate}" for s in statuses if not s.golden]
    short = [lacking(s) for s in statuses if not s.complete]
    return {"windows": len(statuses), "n_not_golden": len(sampled), "n_incomplete": len(short),
            "not_golden": sampled[:NAMED_WINDOWS], "incomplete": short[:NAMED_WINDOWS]}


def target_rows(spark: SparkSession, target: str, days: list[dt.date] | None = None) -> int:
    """Rows of the target, or those of some days (their partitions only)."""
    if newest_partition(spark, target) is None:
        return 0
    table = spark.read.schema(LOADED_BANNERS).parquet(target)
    return (table if days is None else table.where(F.col("date").isin([d.isoformat() for d in days]))).count()


def run_load(spark: SparkSession, landing: str, target: str, params: ReportParams,
             require_complete: bool = True, rejects: str | None = None, leave_incomplete: bool = False) -> dict:
    """Load every window that the target's ledger wants (``streaming/ledger.py``):
    new days, and windows that failed, never landed, or came incomplete or sampled.
    Reports the windows' quality and completeness (the reference's "golden data" /
    "warning" check). An incomplete window stops the load before any write;
    ``require_complete=False`` loads what there is of it, ``leave_incomplete`` loads
    the others only. Both ask for it again."""
    checks: dict = window_checks([])

    def check(statuses: list) -> None:
        checks.update(window_checks(statuses))
        if require_complete and not leave_incomplete and checks["n_incomplete"]:
            raise IncompleteLoad(f"{checks['n_incomplete']} incomplete windows: {checks['incomplete']}")

    done = ledger_load(
        spark, target, ledger_path(target), landed_pages_for(spark, landing), params.banner_dimensions,
        params.banner_metrics, default_start=params.load_default_start, today=params.load_today,
        step=params.window_step_days, check=check, incomplete="leave" if leave_incomplete else "load", rejects=rejects)
    return {"loaded_rows": target_rows(spark, target, done["loaded"]) if done["loaded"] else 0, **checks,
            "n_absent": len(done["absent"]),
            "absent": [f"{a}..{b}" for a, b in done["absent"][:NAMED_WINDOWS]]}


def run_stream_load(spark: SparkSession, landing: str, target: str, checkpoint: str,
                    params: ReportParams) -> dict:
    """Streaming form of the load, into the same table as the batch form: the windows
    of every landed page file not yet processed are put in place; stops when the
    backlog is done. ``loaded_rows`` are the rows the target gained."""
    before = target_rows(spark, target)
    query = stream_windows(spark, landing, target, checkpoint, params.banner_dimensions, params.banner_metrics)
    query.awaitTermination()
    return {"loaded_rows": target_rows(spark, target) - before}


def run_publish(spark: SparkSession, mart: Mart, out: str, params: ReportParams) -> list[dict]:
    return [r.asDict() for r in publish_all(mart, params, out).collect()]


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="trafficlens")
    sub = ap.add_subparsers(dest="cmd", required=True)
    load = sub.add_parser("load", help="append landed API pages after the high-water mark")
    load.add_argument("--landing", required=True)
    load.add_argument("--target", required=True)
    load.add_argument("--today", default=dt.date.today().isoformat())
    load.add_argument("--default-start", default=None)
    load.add_argument("--step", type=int, default=1)
    load.add_argument("--allow-incomplete", action="store_true",
                      help="load windows with fewer landed rows than announced (default: stop before writing)")
    load.add_argument("--leave-incomplete", action="store_true",
                      help="load the other windows and ask for incomplete ones again next time")
    load.add_argument("--rejects", default=None,
                      help="table for rows whose date or numbers do not parse (default: stop)")
    load.add_argument("--stream", action="store_true",
                      help="streaming form: every new landed file once (file-stream source, availableNow)")
    load.add_argument("--checkpoint-location", default=None,
                      help="stream progress folder (shared storage); required with --stream")
    pub = sub.add_parser("publish", help="compute and publish every report")
    pub.add_argument("--mart", help="root with one parquet directory per table")
    pub.add_argument("--testdata", help="derive the mart from a test-data directory instead")
    pub.add_argument("--out", required=True)
    pub.add_argument("--cost-week-year", type=int, default=None, help="year that dates the cost weeks (default: this year)")
    pub.add_argument("--calendar", choices=("reference", "testdata"), default="reference")
    for p in (load, pub):
        p.add_argument("--master", default=None)
        p.add_argument("--shuffle-partitions", type=int, default=None)
    args = ap.parse_args(argv)

    spark = build_session(args.master, shuffle_partitions=args.shuffle_partitions)
    if args.cmd == "load":
        params = ReportParams(load_today=args.today, window_step_days=args.step)
        if args.default_start:
            params = params.with_(load_default_start=args.default_start)
        if args.stream:
            if not args.checkpoint_location:
                ap.error("--stream needs --checkpoint-location")
            print(json.dumps(run_stream_load(spark, args.landing, args.target, args.checkpoint_location, params)))
        else:
            print(json.dumps(run_load(spark, args.landing, args.target, params, not args.allow_incomplete,
                                      args.rejects, args.leave_incomplete)))
    else:
        params = ReportParams.for_testdata() if args.calendar == "testdata" else ReportParams()
        if args.cost_week_year or params.cost_week_year is None:
            params = params.with_(cost_week_year=args.cost_week_year or dt.date.today().year)
        if bool(args.mart) == bool(args.testdata):
            ap.error("give exactly one of --mart / --testdata")
        mart = Mart.from_parquet(spark, args.mart) if args.mart else Mart.from_testdata(spark, args.testdata)
        print(json.dumps(run_publish(spark, mart, args.out, params), ensure_ascii=False))


if __name__ == "__main__":
    main()
