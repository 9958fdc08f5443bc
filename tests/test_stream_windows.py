"""Streaming load beside the batch load on one table."""

from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from pages import DIMS, METS, daily_pages, day_rows, page

from trafficlens.session import local_path
from trafficlens.sources.report_api import current_pages, read_report_pages
from trafficlens.sources.schemas import LOADED_BANNERS
from trafficlens.streaming import incremental as inc


@pytest.fixture()
def table(spark, scratch):
    class Table:
        landing, target, progress = scratch("landing"), scratch("target"), scratch("progress")
        n = 0

        def land(self, pages):
            """More page files beside those already there."""
            for p in pages:
                folder = os.path.join(local_path(self.landing), f"startDate={p['startDate']}")
                os.makedirs(folder, exist_ok=True)
                with open(os.path.join(folder, f"more-{Table.n}.json"), "w") as fh:
                    json.dump({k: v for k, v in p.items() if k != "startDate"}, fh)
                Table.n += 1

        def stream(self, **kw):
            inc.stream_windows(spark, self.landing, self.target, self.progress, DIMS, METS, **kw).awaitTermination(120)

        def batch(self, today, start="2024-01-01"):
            fetch = lambda windows, first, last: current_pages(read_report_pages(spark, self.landing)).where(
                f"startDate >= '{first}' and startDate <= '{last}'")
            inc.incremental_append(spark, self.target, fetch, DIMS, METS, default_start=start, today=today)

        def rows(self):
            return sorted(map(tuple, spark.read.schema(LOADED_BANNERS).parquet(self.target).collect()))

        def expected(self, days, n=3):
            return sorted((str(r[1])[:4] + "-" + r[1][4:6] + "-" + r[1][6:], r[2], int(r[5])) for d in days for r in day_rows(d, n))

        def short(self):
            return sorted((str(r.date), r.eventLabel, int(r.totalevents))
                          for r in spark.read.schema(LOADED_BANNERS).parquet(self.target).collect())

    return Table()


def test_batch_stream_and_a_restart_on_one_table(table):
    table.land(daily_pages([1, 2]))
    table.batch("2024-01-03")
    assert table.short() == table.expected([1, 2])
    table.land(daily_pages([3]))
    table.stream()  # the backlog names days 1 to 3; days 1 and 2 are put in place again
    assert table.short() == table.expected([1, 2, 3])
    table.land(daily_pages([4, 5]))
    table.batch("2024-01-06")
    table.stream(files_per_batch=1)  # a restart: pages of one window in different micro-batches
    assert table.short() == table.expected([1, 2, 3, 4, 5])
    once = table.rows()
    table.stream()
    assert table.rows() == once


def test_a_replayed_micro_batch_changes_nothing(spark, scratch, table):
    table.land(daily_pages([1, 2]))
    table.stream()
    once = table.rows()
    table.progress = scratch("lost-progress")
    table.stream(files_per_batch=1)
    assert table.rows() == once and table.short() == table.expected([1, 2])


def test_incomplete_windows_wait_and_later_landings_win(table):
    first, second = daily_pages([1])
    table.land([first])
    table.land(daily_pages([2]))
    table.stream(incomplete="leave")
    assert table.short() == table.expected([2])
    table.land([second])
    table.stream(incomplete="leave")
    assert table.short() == table.expected([1, 2])
    other = ("01", "20240102", "other", "c", "click", "7", "1")
    table.land([page("2024-01-02", "2024-01-02", "0", [other], 1), page("2024-01-02", "2024-01-02", "2", None, 1)])
    table.stream()
    assert table.short() == sorted(table.expected([1]) + [("2024-01-02", "other", 7)])


def test_rows_outside_their_window_stop_the_stream(table):
    table.land([page("2024-01-01", "2024-01-01", "0", day_rows(2, 1), 1)])
    with pytest.raises(Exception, match="outside its window"):
        table.stream()


def test_layers_keep_windows_of_one_day_apart():
    w = lambda a, b, at: {"startDate": f"2024-01-{a:02}", "endDate": f"2024-01-{b:02}",
                          "newest_landing": dt.datetime(2024, 2, at)}
    one, two, three = w(1, 1, 1), w(2, 2, 1), w(1, 3, 2)
    assert inc.window_layers([three, two, one]) == [[one, two], [three]]
    assert inc.window_layers([]) == []
