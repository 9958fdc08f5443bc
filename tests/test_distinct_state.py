"""Distinct state (A2, A3, R11): bitmaps of days give the counts of one run over all rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trafficlens.functions.calendar import iso_week, month_of
from trafficlens.params import ReportParams
from trafficlens.plans import reports as rp
from trafficlens.plans.catalog import mart
from trafficlens.sinks.snapshots import CommitConflict, SnapshotSet
from trafficlens.streaming.distinct_state import DistinctState

P = ReportParams.for_testdata()


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def visits(spark, some):
    return spark.createDataFrame(some, "date string, city string, user_id string").withColumn("date", F.to_date("date"))


def some_visits(seed, n=600):
    rng = random.Random(seed)
    return [(f"2024-0{rng.randrange(1, 4)}-{rng.randrange(1, 10):02}", rng.choice(["a", "b", None]),
             rng.choice(["hot"] * 30 + [f"u{i}" for i in range(60)] + [None])) for _ in range(n)]


def by_month_and_city(state):
    return state.counts([month_of("date"), F.col("city")], "n")


def test_merges_out_of_order_and_twice_equal_count_distinct(spark, scratch):
    data = some_visits(1)
    state = DistinctState(spark, scratch("distinct"), {"city": T.StringType()}, buckets=4)
    for k in (2, 0, 1, 2):
        state.merge(visits(spark, [r for i, r in enumerate(data) if i % 3 == k]), "user_id")
    frame = visits(spark, data)
    direct = frame.groupBy(month_of("date"), "city").agg(F.countDistinct("user_id"))
    assert rows(by_month_and_city(state)) == rows(direct.where("`count(DISTINCT user_id)` > 0"))
    weekly = frame.groupBy(iso_week("date")).agg(F.countDistinct("user_id"))
    assert rows(state.counts([iso_week("date")], "n")) == rows(weekly)
    numbers = [r.number for r in state.users().collect()]
    assert len(numbers) == len(set(numbers)) == 61


def test_a_new_day_touches_only_its_delta(spark, scratch):
    state = DistinctState(spark, scratch("distinct"), {"city": T.StringType()}, buckets=8)
    first = state.merge(visits(spark, some_visits(2)), "user_id")
    users = state.dictionary.snapshot()
    second = state.merge(visits(spark, [("2024-03-09", "a", "u1"), ("2024-05-01", "a", "new")]), "user_id")
    changed = {k for k in second.members if second.members[k] != first.members.get(k)}
    assert changed == {"date=2024-03-09", "date=2024-05-01"}
    after = state.dictionary.snapshot()
    assert sum(after.members[k] != users.members.get(k) for k in after.members) <= 2
    assert (5, "a", 1) in rows(by_month_and_city(state))


def test_replace_withdraws_rows_and_a_kill_between_the_commits_changes_no_count(spark, scratch, monkeypatch):
    state = DistinctState(spark, scratch("distinct"), {"city": T.StringType()}, buckets=2)
    state.merge(visits(spark, [("2024-01-01", "a", "u1"), ("2024-01-01", "a", "u2"), ("2024-01-02", "a", "u1")]), "user_id")
    before = rows(by_month_and_city(state))
    publish, calls = SnapshotSet._publish, []

    class Killed(BaseException):
        pass

    def second_dies(self, *a):
        calls.append(a)
        if len(calls) == 2:
            raise Killed
        return publish(self, *a)

    late = visits(spark, [("2024-01-03", "a", "u3")])
    with monkeypatch.context() as patch:
        patch.setattr(SnapshotSet, "_publish", second_dies)
        with pytest.raises(Killed):
            state.merge(late, "user_id")
    assert rows(by_month_and_city(state)) == before == [(1, "a", 2)]
    state.merge(late, "user_id")
    assert rows(by_month_and_city(state)) == [(1, "a", 3)]
    state.merge(visits(spark, [("2024-01-01", "a", "u1")]), "user_id", replace=True)
    assert rows(by_month_and_city(state)) == [(1, "a", 2)]
    with pytest.raises(CommitConflict):
        old = state.days.snapshot(1)
        state.days.commit(old, {})


def test_blocks_of_numbers_and_an_empty_state(spark, scratch):
    """More users than one bitmap holds, in one bucket."""
    state = DistinctState(spark, scratch("distinct"), buckets=1)
    assert rows(state.counts([month_of("date")], "n")) == []
    many = spark.range(70_000).select(F.to_date(F.lit("2024-01-01")).alias("date"), F.col("id").cast("string").alias("u"))
    state.merge(many, "u")
    state.merge(many.where("id < 40000").withColumn("date", F.to_date(F.lit("2024-01-02"))), "u")
    assert rows(state.counts([month_of("date")], "n")) == [(1, 70_000)]
    assert state.days.snapshot().table(state.schema).select("block").distinct().count() == 3


def test_monthly_users_from_the_state(spark, scratch):
    m = mart(spark, "/root/testdata/sf0.001")
    state = DistinctState(spark, scratch("distinct"), buckets=4)
    sessions = rp.section_sessions(m, P)
    for odd in (1, 0):
        state.merge(sessions.where(F.dayofyear("date") % 2 == odd), "user_id")
    assert rows(rp.monthly_users_of(state, P)) == rows(rp.report_monthly_users(m, P)) != []
