"""Cohort state (A4, A6, R13): merges of parts equal one run over all traffic."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from trafficlens.params import ReportParams
from trafficlens.plans import reports as rp
from trafficlens.plans.catalog import mart
from trafficlens.sinks.snapshots import SnapshotSet
from trafficlens.streaming.cohort_state import CohortState, cohort_traffic

P = ReportParams.for_testdata()


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_merges_out_of_order_and_twice_equal_one_run(spark, scratch):
    m = mart(spark, "/root/testdata/sf0.001")
    traffic = cohort_traffic(m.table("traffic", ["date", "dimension1", "landingpagepath"]), P)
    state = CohortState(spark, scratch("state"), buckets=4)
    for k in (2, 0, 1, 2):
        state.merge(traffic.where(F.dayofyear("date") % 3 == k), f"part{k}")
    assert state.parts() == ["part2", "part0", "part1", "part2"]
    assert rows(state.retention(P)) == rows(rp.report_retention(m, P)) != []
    state.rebuild(traffic)
    assert rows(state.retention(P)) == rows(rp.report_retention(m, P))


def test_a_killed_merge_leaves_the_state_and_small_parts_touch_few_buckets(spark, scratch, monkeypatch):
    frame = lambda *r: spark.createDataFrame(list(r), "dimension1 string, date string") \
        .withColumn("date", F.to_date("date"))
    state = CohortState(spark, scratch("state"), buckets=8)
    first = state.merge(frame(*[(f"u{i}", "2024-03-05") for i in range(60)], (None, "2024-01-01")), "day1")
    assert len(first.members) == 8

    class Killed(BaseException):
        pass

    def kill(*_):
        raise Killed

    with monkeypatch.context() as patch:
        patch.setattr(SnapshotSet, "_publish", kill)
        with pytest.raises(Killed):
            state.merge(frame(("u1", "2024-01-01")), "day2")
    assert state.parts() == ["day1"] and state.users().agg(F.min("first_date")).first()[0].month == 3
    second = state.merge(frame(("u1", "2024-01-01"), ("u1", "2024-03-20")), "day2")
    assert sum(second.members[k] != first.members[k] for k in first.members) == 1
    u1 = state.users().where("dimension1 = 'u1'").first()
    assert str(u1.first_date) == "2024-01-01" and u1.weeks == (1 << 1) | (1 << 10) | (1 << 12)
    assert state.users().count() == 60
