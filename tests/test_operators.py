"""Filters, joins, aggregates and retention on inline rows, plus plan checks."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from trafficlens.operators import aggregates as agg
from trafficlens.operators import filters as flt
from trafficlens.operators import joins as jn
from trafficlens.operators import retention as ret
from trafficlens.plans.catalog import mart


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_date_bound_on_timestamp_is_pushed(spark):
    ev = mart(spark, "/root/testdata/sf0.001").table("raw_events")
    df = flt.from_date(ev, "dateHourMinute", "2024-01-03")
    text = plan_text(df)
    assert "GreaterThanOrEqual(dateHourMinute,2024-01-03T00:00)" in text


def test_like_is_pushed_as_string_contains(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("/a/nedvizhimost",), ("/b",), (None,)], "p string").write.parquet(path)
    df = flt.url_contains(spark.read.parquet(path), "p", "nedvizhimost")
    assert "StringContains(p,nedvizhimost)" in plan_text(df)
    assert df.count() == 1
    assert flt.url_excludes(spark.read.parquet(path), "p", "nedvizhimost").count() == 1  # NULL dropped


def test_in_year_is_a_range(spark, tmp_path):
    path = str(tmp_path / "d")
    spark.createDataFrame([(dt.date(2023, 12, 31),), (dt.date(2024, 1, 1),), (dt.date(2024, 12, 31),),
                           (dt.date(2025, 1, 1),)], "d date").write.parquet(path)
    df = flt.in_year(spark.read.parquet(path), "d", 2024)
    assert df.count() == 2
    text = plan_text(df)
    assert "GreaterThanOrEqual(d,2024-01-01)" in text and "LessThan(d,2025-01-01)" in text


def test_source_filter_case_and_parse(spark):
    df = spark.createDataFrame([("/x/nedvizhimost", "Banner_a"), ("/x/nedvizhimost", "other"),
                                ("/y", "banner")], "pagepath string, eventLabel string")
    clauses = flt.parse_filter_expression("ga:pagepath=~/nedvizhimost;ga:eventLabel=~banner")
    assert clauses == [("pagepath", "/nedvizhimost"), ("eventLabel", "banner")]
    assert flt.filter_expr(df, clauses).count() == 1
    assert flt.filter_expr(df, clauses, ignore_case=False).count() == 0


def test_null_join_keys_never_match(spark):
    s = spark.createDataFrame([(None, "u1"), ("s1", "u2")], "session_id string, user_id string")
    e = spark.createDataFrame([(None, "L", 1), ("s1", "L", 2)], "dimension4 string, eventlabel string, n bigint")
    out = jn.join_events(s, e, how="left", require="eventlabel")
    assert [(r.user_id, r.n) for r in out.collect()] == [("u2", 2)]


def test_session_fan_out_is_preserved(spark):
    s = spark.createDataFrame([("s1", "u1"), ("s1", "u2")], "session_id string, user_id string")
    e = spark.createDataFrame([("s1", "L", 3)], "dimension4 string, eventlabel string, totalEvents bigint")
    joined = jn.join_events(s, e, how="left", require="eventlabel")
    out = agg.agg_sum_distinct(joined.withColumn("k", F.lit(1)), ["k"], "totalEvents", "t", "user_id", "u").first()
    assert (out.t, out.u) == (6, 2)


def test_outer_join_with_null_test_plans_inner(spark):
    s = spark.createDataFrame([("s1", "u1")], "session_id string, user_id string")
    e = spark.createDataFrame([("s1", "L")], "dimension4 string, eventlabel string")
    for how, req in (("left", "eventlabel"), ("right", "user_id")):
        text = jn.join_events(s, e, how=how, require=req)._jdf.queryExecution().optimizedPlan().toString()
        assert "Join Inner" in text, text


def test_combine_position_vs_key(spark):
    a = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "isoweek bigint, a bigint")
    b = spark.createDataFrame([(1, 100), (3, 300)], "isoweek bigint, b bigint")
    pos = [tuple(r) for r in jn.combine([a, b], how="position").collect()]
    assert pos == [(1, 10, 100), (2, 20, 300), (3, 30, None)]
    key = sorted(tuple(r) for r in jn.combine([a, b], how="key").collect())
    assert key == [(1, 10, 100), (2, 20, None), (3, 30, 300)]


def test_chain_left_with_having_equals_inner_chain(spark):
    m = mart(spark, "/root/testdata/sf0.001")
    views = m.table("page_views").select(F.col("dateHourMinute").cast("date").alias("date"), "dimension4").distinct()
    sess = m.table("sessions").select("date", "session_id", "user_id").distinct()
    users = m.table("users_dim").where(F.col("dimension2") != "not_authorized").select("date", "dimension1").distinct()

    def weekly(how):
        c = jn.chain_left(views, sess, users, how=how)
        out = c.groupBy(F.weekofyear("u_date").alias("w")).agg(F.countDistinct("u_dimension1").alias("n"))
        return sorted(tuple(r) for r in flt.having_positive(out, "n").collect())

    assert weekly("left") == weekly("inner")


def test_second_level_drops_null_keys_and_sorts(spark):
    df = spark.createDataFrame([("b", 1), (None, 5), ("a", 2), ("a", 3)], "k string, v bigint")
    got = [tuple(r) for r in agg.second_level(df, ["k"], {"s": "v"}).collect()]
    assert got == [("a", 5), ("b", 1)]


def test_rounded_sum_is_decimal_exact(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (0.005,)], "c double")
    assert df.agg(agg.rounded_sum("c").alias("s")).first().s == 0.31
    small = spark.range(1000).selectExpr("CAST(0.004 AS DOUBLE) AS c")
    assert small.agg(agg.rounded_sum("c").alias("s")).first().s == 4.0  # the sum is rounded, not the values


def test_cohort_age_wrap_and_year(spark):
    df = spark.createDataFrame([(2, 50), (5, 5), (10, 3)], "w bigint, f bigint")
    assert [r[0] for r in df.select(ret.cohort_age("w", "f")).collect()] == [4, 0, 7]
    d = spark.createDataFrame([(dt.date(2022, 1, 1),), (dt.date(2022, 6, 1),)], "d date")
    assert [r[0] for r in d.select(ret.cohort_year("d", 2021)).collect()] == [2021, 2022]


def test_single_pass_cohorts_equal_the_join_form(spark):
    t = mart(spark, "/root/testdata/sf0.01").table("traffic")
    joined = jn.join_cohort(ret.weekly_activity(t), ret.first_week(t, week52_year=1995))
    single = ret.cohort_members(t, week52_year=1995)
    cols = ["dimension1", "iso_week", "first_dt", "year"]
    assert sorted(map(tuple, joined.select(*cols).collect())) == sorted(map(tuple, single.select(*cols).collect()))


def test_pivot_row_sum_counts_member_weeks(spark):
    t = mart(spark, "/root/testdata/sf0.01").table("traffic")
    pivot = ret.retention_matrix(t, 1995)
    age_cols = [c for c in pivot.columns if c not in ("first_dt", "year")]
    assert len(age_cols) == 53
    total = pivot.select(sum(F.col(c) for c in age_cols).alias("n")).agg(F.sum("n")).first()[0]
    pairs = ret.cohort_members(t, week52_year=1995).count()
    assert total == pairs


def test_bounds_on_timestamp_with_time_zone_columns(spark):
    """On a TIMESTAMP (with time zone) column the bound is read as UTC, like
    the warehouse literals ('... UTC'), whatever the session zone."""
    df = spark.sql("SELECT * FROM VALUES (TIMESTAMP '2024-01-03 16:25:59 UTC'), (TIMESTAMP '2024-01-03 16:26:00 UTC'),"
                   " (TIMESTAMP '2024-01-04 00:00:00 UTC') AS t(ts)")
    assert dict(df.dtypes)["ts"] == "timestamp"
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert flt.from_ts(df, "ts", "2024-01-03 16:26:00").count() == 2
            assert flt.from_ts(df, "ts", "2024-01-03 16:26:00 UTC").count() == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert flt.from_date(df, "ts", "2024-01-04").count() == 1


def test_exact_cohort_ages_over_years_equal_brute_force(spark):
    import datetime as dt
    import random

    from trafficlens.operators import retention as ret

    rng = random.Random(11)
    visits = [(rng.choice([f"u{i}" for i in range(25)] + [None]),
               dt.date(2020, 12, 20) + dt.timedelta(days=rng.randrange(1200))) for _ in range(900)]
    got = sorted(map(tuple, ret.exact_members(spark.createDataFrame(visits, "dimension1 string, date date")).collect()))
    monday = lambda d: d - dt.timedelta(days=d.weekday())
    want = set()
    for user in {u for u, _ in visits if u}:
        dates = [d for u, d in visits if u == user]
        first = min(dates)
        year, week, _ = first.isocalendar()
        want |= {(user, week, year, (monday(d) - monday(first)).days // 7) for d in dates}
    assert got == sorted(want) and max(r[3] for r in got) > 120
    wide = ret.cohort_pivot(ret.exact_members(spark.createDataFrame(visits, "dimension1 string, date date")), 200)
    assert sum(sum(r[2:]) for r in wide.collect()) == len(want)


@pytest.mark.parametrize("how", ["position", "key"])
@pytest.mark.parametrize("rows", [
    [], [(None, 1, 2), (1, 0, 5), (2, 3, 0), (4, 7, 8)], [(3, 0, 0), (1, 0, 4)], [(None, 0, 2), (2, 1, None)],
    [(9, 4, None), (5, 6, 1), (7, 0, 3)]])
def test_frames_of_one_aggregate_combine_as_single_frames_do(spark, how, rows):
    weekly = spark.createDataFrame(rows, "isoweek int, a long, b long")
    single = [weekly.where(F.col(n) > 0).select("isoweek", n) for n in "ab"]
    want = jn.combine(single, "isoweek", how)
    got = jn.combine_wide(weekly, "isoweek", [(n, F.col(n) > 0) for n in "ab"], how)
    assert got.columns == want.columns
    if how == "position":
        assert got.collect() == want.collect()
    else:
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
