"""The window ledger (I1, I3): holes, sampled and incomplete windows, crashes between steps."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pages import daily_pages, day_rows, page, write_landing

from trafficlens.__main__ import run_load
from trafficlens.params import ReportParams
from trafficlens.session import local_path
from trafficlens.sinks import writers
from trafficlens.sources.schemas import LOADED_BANNERS
from trafficlens.streaming import ledger as led

P = ReportParams.for_testdata().with_(load_default_start="2024-01-01", load_today="2024-01-07")  # days 1..6


def day(n: int) -> dt.date:
    return dt.date(2024, 1, n)


def first_pages(days, **kw):
    """As the extractor lands them: days 1 and 2 in one window."""
    rows = day_rows(1) + day_rows(2)
    return [page("2024-01-01", "2024-01-02", "0", rows, 6), *daily_pages(days, **kw)]


def table(spark, target):
    return sorted(tuple(r) for r in spark.read.schema(LOADED_BANNERS).parquet(target).collect())


def days_of(spark, target):
    return {r[-1][-2:]: sum(x[-1] == r[-1] for x in table(spark, target)) for r in table(spark, target)}


def wanted(spark, target, today="2024-01-07"):
    last = dt.date.fromisoformat(today) - dt.timedelta(days=1)
    return [(w.window_start.day, w.window_end.day, w.reason) for w in
            led.wanted_windows(led.read_ledger(spark, led.ledger_path(target)), "2024-01-01", last).collect()]


def test_a_hole_is_asked_for_until_it_lands(spark, scratch):
    landing, target = scratch("landing"), scratch("target")
    write_landing(local_path(landing), first_pages([3, 6]))
    assert wanted(spark, target) == [(1, 2, "new"), (3, 3, "new"), (4, 4, "new"), (5, 5, "new"), (6, 6, "new")]
    report = run_load(spark, landing, target, P)
    assert report["absent"] == ["2024-01-04..2024-01-04", "2024-01-05..2024-01-05"] and report["loaded_rows"] == 12
    assert wanted(spark, target) == [(4, 4, "absent"), (5, 5, "absent")]  # the windows it asked for, not [4, 5]
    write_landing(local_path(landing), daily_pages([5]))
    assert run_load(spark, landing, target, P)["loaded_rows"] == 3
    assert days_of(spark, target) == {"01": 3, "02": 3, "03": 3, "05": 3, "06": 3}
    later = P.with_(load_today="2024-01-08")
    write_landing(local_path(landing), daily_pages([4, 7]))
    assert run_load(spark, landing, target, later)["loaded_rows"] == 6
    assert wanted(spark, target, "2024-01-08") == []
    assert run_load(spark, landing, target, later)["loaded_rows"] == 0


def test_sampled_and_incomplete_windows_are_replaced_when_they_land_anew(spark, scratch):
    landing, target = scratch("landing"), scratch("target")
    pages = first_pages([3, 4, 5, 6])
    for p in pages:
        if p["startDate"] == "2024-01-04":
            p["reports"][0]["data"]["samplesReadCounts"] = ["1"]
    lost = next(p for p in pages if p["startDate"] == "2024-01-05" and p["pageToken"] == "2")
    write_landing(local_path(landing), [p for p in pages if p is not lost])
    report = run_load(spark, landing, target, P, leave_incomplete=True)
    assert (report["n_not_golden"], report["n_incomplete"], report["loaded_rows"]) == (1, 1, 15)
    assert "05" not in days_of(spark, target)
    assert wanted(spark, target) == [(4, 4, "sampled"), (5, 5, "absent")]
    again = run_load(spark, landing, target, P, leave_incomplete=True)
    assert again["windows"] == 2 and again["loaded_rows"] == 0  # nothing newer has landed
    folder = os.path.join(local_path(landing), "startDate=2024-01-04")
    for name in os.listdir(folder):  # the sampled day lands again, whole and with other rows
        os.unlink(os.path.join(folder, name))
    write_landing(local_path(landing), [page("2024-01-04", "2024-01-04", "0", day_rows(4, 2), 2), lost])
    os.utime(os.path.join(folder, "page-0.json"), (1_900_000_000, 1_900_000_000))
    write_landing(local_path(landing), [p for p in pages if p["startDate"] == "2024-01-05"])
    assert run_load(spark, landing, target, P, leave_incomplete=True)["loaded_rows"] == 5
    assert days_of(spark, target) == {"01": 3, "02": 3, "03": 3, "04": 2, "05": 3, "06": 3}
    assert wanted(spark, target) == []


@pytest.mark.parametrize("crash", ["before data", "within data", "after data"])
def test_a_crash_between_the_steps_is_made_good(spark, scratch, monkeypatch, crash):
    landing, target = scratch("landing"), scratch("target")
    write_landing(local_path(landing), first_pages([3, 4, 5, 6]))
    real_record, real_replace = led.record, led.replace_days

    class Crash(RuntimeError):
        pass

    def record(spark, path, rows):
        if crash == "after data" and any(r[2] == "loaded" for r in rows):
            raise Crash
        real_record(spark, path, rows)

    def replace(df, path, days):
        if crash == "before data":
            raise Crash
        if crash == "within data":  # some of the dates only
            writers.replace_dates(df.where("date <= '2024-01-03'"), path)
            raise Crash
        real_replace(df, path, days)

    monkeypatch.setattr(led, "record", record)
    monkeypatch.setattr(led, "replace_days", replace)
    with pytest.raises(Crash):
        run_load(spark, landing, target, P)
    assert {r for _, _, r in wanted(spark, target)} == {"unfinished"} and len(wanted(spark, target)) == 5
    monkeypatch.undo()
    assert run_load(spark, landing, target, P)["loaded_rows"] == 18
    assert days_of(spark, target) == {f"0{d}": 3 for d in range(1, 7)}
    assert wanted(spark, target) == []


def test_a_day_that_became_empty_is_emptied(spark, scratch):
    landing, target = scratch("landing"), scratch("target")
    sampled = first_pages([3, 4, 5, 6])
    for p in sampled:
        p["reports"][0]["data"]["samplesReadCounts"] = ["1"]
    write_landing(local_path(landing), sampled)
    run_load(spark, landing, target, P)
    folder = os.path.join(local_path(landing), "startDate=2024-01-01")
    for name in os.listdir(folder):
        os.unlink(os.path.join(folder, name))
    write_landing(local_path(landing), [page("2024-01-01", "2024-01-02", "0", day_rows(2), 3)])
    os.utime(os.path.join(folder, "page-0.json"), (1_900_000_000, 1_900_000_000))
    run_load(spark, landing, target, P)
    assert days_of(spark, target) == {f"0{d}": 3 for d in range(2, 7)}


def test_rows_outside_their_window_stop_the_load(spark, scratch):
    landing, target = scratch("landing"), scratch("target")
    write_landing(local_path(landing), [page("2024-01-01", "2024-01-02", "0", day_rows(20), 3)])
    with pytest.raises(Exception, match="outside the requested windows: 2024-01-20"):
        run_load(spark, landing, target, P)


def test_a_target_without_a_ledger_keeps_its_days(spark, scratch):
    landing, target = scratch("landing"), scratch("target")
    write_landing(local_path(landing), first_pages([3, 4, 5, 6]))
    run_load(spark, landing, target, P)
    old, other = table(spark, target), scratch("old-target")
    rows = spark.read.schema(LOADED_BANNERS).parquet(target).where("date <> '2024-01-04'")
    writers.append(rows, other)
    assert run_load(spark, landing, other, P)["loaded_rows"] == 3  # only the day it lacks
    assert table(spark, other) == old


def test_windows_follow_runs_of_free_days(spark):
    rows = [(day(3), day(4), "loaded", 1, 1, True, True, None, "a", 1), (day(9), day(9), "loaded", 1, 1, True, False, None, "a", 1),
            (day(9), day(9), "loaded", 1, 1, True, True, None, "b", 2), (day(12), day(12), "started", 1, 1, True, True, None, "b", 5),
            (day(12), day(12), "loaded", 1, 1, True, True, None, "a", 4)]
    ledger = spark.createDataFrame(rows, led.LEDGER)
    got = [(w.window_start.day, w.window_end.day, w.reason) for w in led.wanted_windows(ledger, day(1), day(14), 2).collect()]
    assert got == [(1, 2, "new"), (5, 6, "new"), (7, 8, "new"), (10, 11, "new"), (12, 12, "unfinished"), (13, 14, "new")]
    assert led.wanted_windows(ledger, day(15), day(14)).collect() == []
