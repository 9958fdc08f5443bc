"""Edge behaviour of the building blocks."""

from __future__ import annotations

import datetime as dt

import pytest

from trafficlens.functions import tagging as tag
from trafficlens.operators import joins as jn
from trafficlens.operators.filters import normalize_ts, parse_filter_expression
from trafficlens.sources.mart import Mart
from trafficlens.sources.schemas import SchemaMismatch
from trafficlens.streaming import incremental as inc


def test_high_water_mark_on_a_date_column(spark):
    target = spark.createDataFrame([(dt.date(2024, 1, 7),), (dt.date(2024, 1, 9),)], "date date")
    row = inc.high_water_mark(target, "2024-01-01", dt.date(2024, 2, 1)).first()
    assert (row.max_date, row.start_date, row.end_date) == (dt.date(2024, 1, 9), dt.date(2024, 1, 10),
                                                            dt.date(2024, 1, 31))


def test_mart_rejects_a_table_with_wrong_types(spark):
    bad = spark.createDataFrame([("x", "y")], "date string, CITY string")
    with pytest.raises(SchemaMismatch):
        Mart({"costs": bad})


def test_mart_resolves_names_case_insensitively(spark):
    ok = spark.createDataFrame([(dt.date(2024, 1, 1), "A", 1.5)], "DATE date, city string, costs double")
    assert Mart({"costs": ok}).table("costs").columns == ["date", "CITY", "COSTS"]


def test_keyed_combine_keeps_null_keys_apart(spark):
    a = spark.createDataFrame([(None, 1), (1, 2)], "isoweek bigint, a bigint")
    b = spark.createDataFrame([(None, 10), (1, 20)], "isoweek bigint, b bigint")
    got = sorted((tuple(r) for r in jn.combine([a, b], how="key").collect()), key=repr)
    assert got == sorted([(None, 1, None), (None, None, 10), (1, 2, 20)], key=repr)


def test_regex_prefix_escapes_the_separator(spark):
    df = spark.createDataFrame([("a.b.c",), ("abc",)], "x string")
    assert [r[0] for r in df.select(tag.regex_prefix("x", ".")).collect()] == ["a", None]


def test_timestamp_text_normalisation():
    assert normalize_ts("2022-01-03 00:00:01 UTC") == "2022-01-03 00:00:01"
    assert normalize_ts("2022-01-03T16:26:00") == "2022-01-03 16:26:00"
    assert normalize_ts("2022-01-03") == "2022-01-03 00:00:00"


def test_filter_expression_rejects_or_clauses():
    assert parse_filter_expression("ga:pagepath=~/x") == [("pagepath", "/x")]
    with pytest.raises(ValueError):
        parse_filter_expression("ga:pagepath=~/x,ga:eventLabel=~y")


def test_purify_calls_parses_text_dates(spark):
    from trafficlens.operators.cleanup import purify_calls

    df = spark.createDataFrame([("2022-01-01", "second_x", "3", "1")],
                               "date string, utm_campaign string, totalEvents string, uniqueEvents string")
    row = purify_calls(df).first()
    assert (row.date, row.week, row.totalEvents, row.uniqueEvents) == (dt.date(2022, 1, 1), 52, 3, 1)


def test_approximate_distinct_is_opt_in(spark):
    from trafficlens.params import ReportParams
    from trafficlens.plans.catalog import mart
    from trafficlens.plans.reports import report_monthly_users

    m = mart(spark, "/root/testdata/sf0.01")
    p = ReportParams.for_testdata()
    exact = {r.month: r.uniqs for r in report_monthly_users(m, p).collect()}
    approx = {r.month: r.uniqs for r in report_monthly_users(m, p.with_(approx_distinct=True)).collect()}
    assert exact.keys() == approx.keys()
    assert all(abs(approx[k] - exact[k]) <= 0.1 * exact[k] for k in exact)


def test_empty_banner_table_gives_no_windows_pages_or_rows(spark, scratch):
    from trafficlens.params import ReportParams
    from trafficlens.plans.catalog import banner_windows, nested_banner_rows
    from trafficlens.plans.reports import report_banners
    from trafficlens.sources.schemas import BANNER_HITS, BANNERS

    empty = Mart.written(spark, {"banners": spark.createDataFrame([], BANNERS),
                                 "banner_hits": spark.createDataFrame([], BANNER_HITS)}, scratch("empty-mart"))
    p = ReportParams.for_testdata()
    assert banner_windows(empty, p=p).count() == 0
    assert nested_banner_rows(empty).count() == 0
    assert report_banners(empty, p).count() == 0
    mark = inc.high_water_mark(empty.table("banners"), "2024-01-01", "2024-01-31").first()
    assert mark.start_date == dt.date(2024, 1, 1)


def test_reports_run_with_the_reference_calendar(spark):
    """The production defaults (2022 bounds) also plan and run over the test
    mart; reports whose bounds miss its calendar are simply empty."""
    from trafficlens.params import ReportParams
    from trafficlens.plans.catalog import mart
    from trafficlens.plans.reports import REPORTS

    m = mart(spark, "/root/testdata/sf0.001")
    with pytest.raises(ValueError, match="cost_week_year"):
        REPORTS["report_weekly_cost"](m, ReportParams())
    with pytest.raises(ValueError, match="retention_max_age"):
        REPORTS["report_retention"](m, ReportParams(retention_max_age=10))
    p = ReportParams(cost_week_year=2022)
    counts = {name: fn(m, p).count() for name, fn in REPORTS.items()}
    assert counts["report_phone_clicks"] > 0 and counts["report_banners"] > 0
    assert counts["report_weekly_cost"] == 0  # the costs end in 2001


def test_weeks_with_their_year_stay_apart(spark):
    """``with_iso_year``: costs of several years by (ISO year, week, city), dated by
    the week's own year; the sums over the years are the default report's."""
    import duckdb

    from trafficlens.params import ReportParams
    from trafficlens.plans.catalog import mart
    from trafficlens.plans.reports import REPORTS
    from trafficlens.sources.fixtures import duckdb_ctes

    sf = "/root/testdata/sf0.001"
    m, p = mart(spark, sf), ReportParams.for_testdata()
    got = sorted((r.isoyear, r.isoweek, r.CITY, r.start_week, round(r.COST, 2))
                 for r in REPORTS["report_weekly_cost"](m, p.with_(with_iso_year=True)).collect())
    con = duckdb.connect()
    for t in ("orders", "customer"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = con.execute(f"""{duckdb_ctes(['costs'])}
        SELECT isoyear(date), week(date), CITY, CAST(MIN(date_trunc('week', date)::DATE) AS VARCHAR),
               CAST(ROUND(SUM(CAST(COSTS AS DECIMAL(28, 10))), 2) AS DOUBLE)
        FROM costs WHERE COSTS > 0 AND date >= DATE '1996-01-01' GROUP BY 1, 2, 3""").fetchall()
    assert got == sorted((a, b, c, d, round(e, 2)) for a, b, c, d, e in want) and len({g[0] for g in got}) > 3
    for name in ("report_vas_by_action", "report_mortgage", "report_claims", "report_registrations",
                 "report_vas_by_city"):
        rows = REPORTS[name](m, p.with_(with_iso_year=True)).collect()
        plain = REPORTS[name](m, p).collect()
        assert {r.isoyear for r in rows} <= {2023, 2024} and len(rows) == len(plain)
