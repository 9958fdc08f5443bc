"""The command-line run: load landed pages, publish every report."""

from __future__ import annotations

import datetime as dt
import glob
import json

import pytest
from pages import DIMS, daily_pages, day_rows, page, write_landing

from trafficlens.__main__ import IncompleteLoad, landed_pages_for, main, run_load
from trafficlens.params import ReportParams
from trafficlens.plans.registry import DESTINATIONS, published
from trafficlens.session import local_path
from trafficlens.sources.schemas import LOADED_BANNERS
from trafficlens.streaming.incremental import date_windows

SF = "/root/testdata/sf0.001"
# One-day windows; the oldest window of a load spans two days.
P = ReportParams.for_testdata().with_(load_default_start="2024-01-01", load_today="2024-01-11")


def two_day_first(days):
    """Pages as the extractor lands them for a first load: days 1 and 2 in one window."""
    rows = day_rows(1) + day_rows(2)
    return [page("2024-01-01", "2024-01-02", "0", rows[:4], 6), page("2024-01-01", "2024-01-02", "4", rows[4:], 6),
            *daily_pages(days)]


def table(spark, target):
    return sorted(tuple(r) for r in spark.read.schema(LOADED_BANNERS).parquet(target).collect())


def test_load_writes_every_row_once_and_moves_the_mark(spark, scratch):
    landing, target = scratch("landing"), scratch("target")
    write_landing(local_path(landing), two_day_first(range(3, 11)))
    first = run_load(spark, landing, target, P)
    assert first["loaded_rows"] == 30 and first["windows"] == 9
    assert first["n_not_golden"] == first["n_incomplete"] == 0
    want = sorted((w, label, c, a, n, int(u), f"{d[:4]}-{d[4:6]}-{d[6:]}")
                  for day in range(1, 11) for w, d, label, c, a, n, u in day_rows(day))
    assert table(spark, target) == want
    assert run_load(spark, landing, target, P)["loaded_rows"] == 0  # the mark moved past every window
    assert table(spark, target) == want


def test_publish_command_writes_every_destination(spark, scratch, capsys):
    out = scratch("cli-out")
    main(["publish", "--testdata", SF, "--out", out, "--calendar", "testdata"])
    summary = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert {r["report_name"] for r in summary} == set(DESTINATIONS)
    for name in DESTINATIONS:
        assert len(glob.glob(local_path(published(spark, out).path(name)) + "/part-*.csv")) >= 1


def test_fetch_reads_only_the_requested_window_directories(spark, scratch):
    landing = scratch("landing")
    write_landing(local_path(landing), daily_pages(range(1, 31)))
    wanted = date_windows(spark, "2024-01-28", "2024-01-30", 1)  # [28, 29], [30, 30]
    pages = landed_pages_for(spark, landing)(wanted, dt.date(2024, 1, 28), dt.date(2024, 1, 30))
    plan = pages._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    filters = [ln for ln in plan.split("\n") if ln.startswith("PartitionFilters")]
    assert filters and ">= 2024-01-28" in filters[0] and "<= 2024-01-30" in filters[0]
    # the landing holds one-day windows, so only [30, 30] matches both bounds
    assert {r.startDate for r in pages.select("startDate").distinct().collect()} == {"2024-01-30"}


def test_short_and_sampled_windows(spark, scratch):
    """A window that lacks a page stops the load before any write unless asked
    otherwise; a sampled window is reported."""
    pages = two_day_first(range(3, 11))
    lost = next(p for p in pages if p["startDate"] == "2024-01-05" and p["pageToken"] == "2")
    pages.remove(lost)
    for p in pages:
        if p["startDate"] == "2024-01-07":
            p["reports"][0]["data"]["samplesReadCounts"] = ["1"]
    landing, target = scratch("landing"), scratch("target")
    write_landing(local_path(landing), pages)
    with pytest.raises(IncompleteLoad):
        run_load(spark, landing, target, P)
    assert not glob.glob(local_path(target) + "/date=*")
    report = run_load(spark, landing, target, P, require_complete=False)
    assert report["loaded_rows"] == 29
    assert report["n_incomplete"] == 1 and report["incomplete"] == ["2024-01-05..2024-01-05 (2/3) missing rows 2-2"]
    assert report["not_golden"] == ["2024-01-07..2024-01-07"]


def test_rows_that_do_not_parse_stop_the_load_or_are_set_apart(spark, scratch):
    pages = two_day_first(range(3, 11))
    pages[2]["reports"][0]["data"]["rows"][0]["dimensions"][1] = "2024-13-99"
    landing, target, rejects = scratch("landing"), scratch("target"), scratch("rejects")
    write_landing(local_path(landing), pages)
    with pytest.raises(Exception, match="malformed date: 2024-13-99"):
        run_load(spark, landing, target, P)
    assert run_load(spark, landing, target, P, rejects=rejects)["loaded_rows"] == 29
    assert [r["date"] for r in spark.read.parquet(rejects).collect()] == ["2024-13-99"]


def test_columns_are_taken_by_the_response_header(spark, scratch):
    swapped = (DIMS[2], DIMS[1], DIMS[0], DIMS[3], DIMS[4])
    rows = [(label, d, w, c, a, u, n) for w, d, label, c, a, n, u in day_rows(3)]
    good = page("2024-01-03", "2024-01-03", "0", rows, 3, dims=swapped, mets=("ga:users", "ga:totalevents"))
    p = P.with_(load_default_start="2024-01-03", load_today="2024-01-04")
    straight, turned = scratch("straight"), scratch("turned")
    write_landing(local_path(straight), daily_pages([3]))
    write_landing(local_path(turned), [good])
    targets = [scratch("t1"), scratch("t2")]
    for landing, target in zip((straight, turned), targets, strict=True):
        run_load(spark, landing, target, p)
    assert table(spark, targets[0]) == table(spark, targets[1])
    short = page("2024-01-03", "2024-01-03", "0", [r[:4] + r[5:] for r in rows], 3, dims=swapped[:4])
    landing = scratch("short")
    write_landing(local_path(landing), [short])
    with pytest.raises(Exception, match="without dimension ga:eventAction"):
        run_load(spark, landing, scratch("t3"), p)


def test_stream_load_command_writes_each_landed_page_once(spark, scratch, capsys):
    landing, target, ckpt = scratch("landing"), scratch("stream-target"), scratch("stream-ckpt")
    write_landing(local_path(landing), daily_pages(range(1, 31)))
    args = ["load", "--stream", "--landing", landing, "--target", target, "--checkpoint-location", ckpt]
    main(args)
    main(args)  # nothing new landed: no second copy
    out = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()[-2:]]
    assert [o["loaded_rows"] for o in out] == [90, 0]
    assert spark.read.parquet(target).count() == 90
