"""Report pages, load windows, high-water mark, append, streaming load."""

from __future__ import annotations

import datetime as dt
import json
import os

from hypothesis import given, settings
from hypothesis import strategies as st
from pages import DIMS, METS, daily_pages, page, write_landing

from trafficlens.session import local_path
from trafficlens.sinks.writers import append, replace_dates
from trafficlens.sources.report_api import (flatten_report, page_completeness, quality_flag,
                                            read_report_pages, window_status)
from trafficlens.streaming import incremental as inc

def collect_windows(spark, start: dt.date, end: dt.date, step: int):
    return [(r.window_start, r.window_end) for r in inc.date_windows(spark, start, end, step).collect()]


def test_date_windows_edge_cases(spark):
    d = dt.date(2024, 1, 1)
    day = dt.timedelta(days=1)
    assert collect_windows(spark, d, d + 2 * day, 1) == [(d, d + day), (d + 2 * day, d + 2 * day)]
    assert collect_windows(spark, d, d, 1) == [(d, d)]
    assert collect_windows(spark, d + 2 * day, d, 1) == []


@settings(max_examples=25, deadline=None)
@given(n_days=st.integers(min_value=1, max_value=15), step=st.integers(min_value=1, max_value=5))
def test_date_windows_follow_the_rule(spark, n_days, step):
    """Spec: windows cover [start, end] contiguously, oldest first; working back
    from ``end`` every window has exactly ``step`` days except the oldest, which
    takes the remainder and so spans 2 .. step + 1 days."""
    base = dt.date(2024, 1, 1)
    end = base + dt.timedelta(days=n_days)
    got = collect_windows(spark, base, end, step)
    lengths = [(b - a).days + 1 for a, b in got]
    assert got[0][0] == base and got[-1][1] == end
    assert all(got[i][1] + dt.timedelta(days=1) == got[i + 1][0] for i in range(len(got) - 1))
    assert all(n == step for n in lengths[1:])
    assert 2 <= lengths[0] <= step + 1
    assert sum(lengths) == n_days + 1


def test_high_water_mark_empty_and_filled(spark):
    empty = spark.createDataFrame([], "date string")
    row = inc.high_water_mark(empty, "2024-01-01", "2024-02-01").first()
    assert (row.max_date, row.start_date, row.end_date) == (None, dt.date(2024, 1, 1), dt.date(2024, 1, 31))
    filled = spark.createDataFrame([("2024-01-05",), ("2024-01-09",)], "date string")
    row = inc.high_water_mark(filled, "2024-01-01", "2024-02-01").first()
    assert row.start_date == dt.date(2024, 1, 10)


def write_json_pages(path, pages):
    os.makedirs(path, exist_ok=True)
    for i, p in enumerate(pages):
        with open(os.path.join(path, f"page-{i}.json"), "w") as fh:
            json.dump(p, fh, indent=2)


def test_report_pages_flatten_quality_and_completeness(spark, scratch):
    root = local_path(scratch("pages"))
    r = lambda day, n: ("01", day, "banner_x", "c", "click", str(n), "1")
    pages = [
        page("2024-01-01", "2024-01-01", "0", [r("20240101", 1), r("20240101", 2)], 10003),
        page("2024-01-01", "2024-01-01", "10000", [r("20240101", 3)], 10003),
        page("2024-01-02", "2024-01-02", "0", None, None),
        page("2024-01-03", "2024-01-03", "0", [r("20240103", 4)], 1, sampled=True),
    ]
    write_json_pages(root, pages)
    landed = read_report_pages(spark, root, multi_line=True)
    flat = flatten_report(landed, DIMS, METS)
    assert flat.columns == list(DIMS) + list(METS)
    assert sorted(int(x[0]) for x in flat.select("`ga:totalevents`").collect()) == [1, 2, 3, 4]
    q = {row.startDate: row.golden for row in quality_flag(landed).collect()}
    assert q == {"2024-01-01": True, "2024-01-02": True, "2024-01-03": False}
    c = {row.startDate: (row.expected_rows, row.landed_rows, row.complete)
         for row in page_completeness(landed).collect()}
    assert c == {"2024-01-01": (10003, 3, False), "2024-01-02": (0, 0, True), "2024-01-03": (1, 1, True)}
    both = {row.startDate: (row.expected_rows, row.landed_rows, row.complete, row.golden)
            for row in window_status(landed).collect()}
    assert both == {d: (*c[d], q[d]) for d in c}
    typed = inc.typed_report_rows(landed, DIMS, METS)
    assert dict(typed.dtypes) == {"isoweek": "string", "date": "string", "eventLabel": "string",
                                  "eventCategory": "string", "eventAction": "string",
                                  "totalevents": "string", "users": "bigint"}
    assert {x.date for x in typed.collect()} == {"2024-01-01", "2024-01-03"}


def test_append_keeps_all_rows_and_replace_dates_replaces(spark, scratch):
    target = scratch("append")
    frame = lambda *rows: spark.createDataFrame(list(rows), "date string, v bigint")
    values = lambda: sorted(r.v for r in spark.read.parquet(target).collect())
    append(frame(("2024-01-01", 1), (None, 9)), target)
    append(frame(("2024-01-01", 2), (None, 8)), target)
    assert values() == [1, 2, 8, 9]
    replace_dates(frame(("2024-01-01", 5), ("2024-01-02", 6)), target)
    replace_dates(frame(("2024-01-01", 5), ("2024-01-02", 6)), target)
    assert values() == [5, 6, 8, 9]


def test_newest_partition_reads_the_listing_only(spark, scratch):
    target = scratch("marks")
    assert inc.newest_partition(spark, target) is None
    append(spark.createDataFrame([("2024-01-09", 1), ("2024-01-05", 2), (None, 3)], "date string, v bigint"), target)
    assert inc.newest_partition(spark, target) == "2024-01-09"
    assert inc.load_bounds(spark, target, "2024-01-01", "2024-02-01") == (dt.date(2024, 1, 10), dt.date(2024, 1, 31))


def test_incremental_append_moves_the_mark_in_few_jobs(spark, scratch):
    from trafficlens.plans.catalog import mart, nested_banner_rows
    from trafficlens.sources.schemas import LOADED_BANNERS

    m = mart(spark, "/root/testdata/sf0.001")
    target = scratch("inc")
    calls = []

    def fetch(windows, first, last):
        calls.append((first, last))
        return nested_banner_rows(m, first.isoformat(), last.isoformat())

    load = lambda today: inc.incremental_append(
        spark, target, fetch, DIMS, METS, default_start="2024-01-01", today=today)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("one-load", "one load")
    assert load("2024-01-10") == (dt.date(2024, 1, 1), dt.date(2024, 1, 9))
    jobs = len(tracker.getJobIdsForGroup("one-load"))
    spark.sparkContext.setJobGroup("other", "other")
    assert 1 <= jobs <= 4
    n1 = spark.read.schema(LOADED_BANNERS).parquet(target).count()
    load("2024-01-10")  # up to date: no request at all
    assert len(calls) == 1 and spark.read.schema(LOADED_BANNERS).parquet(target).count() == n1
    load("2024-01-31")
    assert calls[1] == (dt.date(2024, 1, 10), dt.date(2024, 1, 30))
    got = spark.read.schema(LOADED_BANNERS).parquet(target).count()
    assert got == inc.typed_report_rows(nested_banner_rows(m), DIMS, METS).where("date <= '2024-01-30'").count()


def test_load_scans_the_source_once_and_prunes_it(spark):
    from trafficlens.plans.catalog import mart, nested_banner_rows

    rows = inc.typed_report_rows(nested_banner_rows(mart(spark, "/root/testdata/sf0.001"), "2024-01-05", "2024-01-09"),
                                 DIMS, METS)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "PartitionFilters: [isnotnull(date" in plan and "Exchange" not in plan


def test_streaming_load_is_exactly_once(spark, scratch):
    landing_dir, target, ckpt = scratch("landing"), scratch("stream-target"), scratch("stream-ckpt")
    write_landing(local_path(landing_dir), daily_pages(range(1, 8)))
    for _ in range(2):  # a restart with nothing new: the commit log prevents a second copy
        inc.stream_landed_pages(spark, landing_dir, target, ckpt, DIMS, METS).awaitTermination(120)
        assert spark.read.parquet(target).count() == 21
    write_landing(local_path(landing_dir), daily_pages([9]))
    inc.stream_landed_pages(spark, landing_dir, target, ckpt, DIMS, METS).awaitTermination(120)
    assert spark.read.parquet(target).count() == 24


def test_banner_report_over_loaded_table_equals_source(spark, scratch):
    """R14 over the incrementally loaded rows equals R14 over the requested hits."""
    from trafficlens.operators import filters as flt
    from trafficlens.params import ReportParams
    from trafficlens.plans.catalog import mart, nested_banner_rows
    from trafficlens.plans.reports import report_banners
    from trafficlens.sources.schemas import LOADED_BANNERS

    m = mart(spark, "/root/testdata/sf0.001")
    p = ReportParams.for_testdata()
    target = scratch("loaded-banners")
    inc.incremental_append(spark, target, lambda w, first, last: nested_banner_rows(m, str(first), str(last)), DIMS,
                           METS, default_start=p.load_default_start, today=p.load_today)
    loaded = m.with_table("banners", spark.read.schema(LOADED_BANNERS).parquet(target))
    hits = flt.filter_expr(m.table("banner_hits"), flt.parse_filter_expression(p.banner_filter)).drop("pagepath")
    got = sorted(tuple(r) for r in report_banners(loaded, p).collect())
    want = sorted(tuple(r) for r in report_banners(m.with_table("banners", hits), p).collect())
    assert got == want and len(got) > 0
