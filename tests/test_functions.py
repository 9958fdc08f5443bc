"""Column expressions: calendar, tagging, column utilities (inline rows)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from trafficlens.functions import calendar as cal
from trafficlens.functions import columns as cols
from trafficlens.functions import tagging as tag
from trafficlens.functions.tagging import (CAMPAIGN_NEW_BUILD, CAMPAIGN_NON_AD, CAMPAIGN_OTHER,
                                           CAMPAIGN_SECONDARY)


def one_col(spark, values, type_="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {type_}")


def test_iso_week_year_start(spark):
    df = one_col(spark, [dt.date(2022, 1, 1), dt.date(2021, 1, 3)], "date")
    got = [r[0] for r in df.select(cal.iso_week("x")).collect()]
    assert got == [52, 53]
    years = [r[0] for r in df.select(cal.iso_year("x")).collect()]
    assert years == [2021, 2020]


def test_iso_week_monday(spark):
    df = spark.createDataFrame([(2022, 1), (2022, 53), (1996, 1)], "y int, w bigint")
    got = [r[0] for r in df.select(cal.iso_week_monday(F.col("w"), F.col("y"))).collect()]
    assert got == [dt.date(2022, 1, 3), dt.date(2023, 1, 2), dt.date(1996, 1, 1)]
    lit_year = df.select(cal.iso_week_monday(F.lit(1), 2022)).first()[0]
    assert lit_year == dt.date(2022, 1, 3)


def test_iso_week_monday_is_monday_of_each_date(spark):
    days = spark.range(0, 3 * 366).select(F.date_add(F.lit("2020-12-20").cast("date"), F.col("id").cast("int")).alias("d"))
    bad = days.where(cal.iso_week_monday(cal.iso_week("d"), cal.iso_year("d")) != F.date_sub("d", F.weekday("d")))
    assert bad.count() == 0


def test_date_parsers(spark):
    df = one_col(spark, ["20240105", "2024-01-05", "junk", None])
    got = df.select(cal.parse_compact_date("x"), cal.parse_iso_date("x")).collect()
    assert [tuple(r) for r in got] == [(dt.date(2024, 1, 5), None), (None, dt.date(2024, 1, 5)),
                                       (None, None), (None, None)]


def test_regex_prefix(spark):
    df = one_col(spark, ["abc", "_x", "a_b_c", None])
    got = df.select(tag.regex_prefix("x").alias("p")).collect()
    assert [r.p for r in got] == [None, "", "a", None]
    kept = df.where(tag.length_positive(tag.regex_prefix("x")))
    assert [r.x for r in kept.collect()] == ["a_b_c"]


def test_campaign_type_order_and_null(spark):
    df = one_col(spark, ["second_new-building", "new-building_spb", "(not set)", "brand", None])
    got = [r[0] for r in df.select(tag.campaign_type("x")).collect()]
    assert got == [CAMPAIGN_SECONDARY, CAMPAIGN_NEW_BUILD, CAMPAIGN_NON_AD, CAMPAIGN_OTHER, None]


def test_banner_tags_first_match_wins(spark):
    df = one_col(spark, ["onlinebuy_guarantee", "card_serp", "view_click", "Banner_SERP", "x", None])
    got = df.select(tag.tag_product("x"), tag.tag_location("x"), tag.tag_action("x")).collect()
    assert [tuple(r) for r in got] == [
        ("protection", None, None),
        (None, "SERP", None),
        (None, None, "click"),
        (None, "SERP", None),
        (None, None, None),
        (None, None, None),
    ]


def test_geo_and_city(spark):
    df = one_col(spark, ["/moskva/x", "/leningradskaya-oblast/y", "/Moskva", "/mosk", None])
    got = df.select(tag.tag_geo("x"), tag.city_bucket("x", "REG")).collect()
    assert [tuple(r) for r in got] == [("MSK", "MSK"), ("SPB", "SPB"), (None, "REG"), (None, "MSK"),
                                       (None, "REG")]


def test_lower_contains(spark):
    df = one_col(spark, ["A_SeRp", "card", None])
    assert [r[0] for r in df.select(tag.lower_contains("x", "serp")).collect()] == [True, False, None]


def test_column_utilities(spark):
    df = spark.createDataFrame([("1", "2", None, 3.5)], "`ga:a` string, `ga:B` string, c string, d double")
    norm = cols.normalize_columns(df, "ga:", lower=True)
    assert norm.columns == ["a", "b", "c", "d"]
    typed = cols.cast_metrics(norm, ["a", "B"])  # exact-name match: only "a" is cast
    assert dict(typed.dtypes) == {"a": "bigint", "b": "string", "c": "string", "d": "double"}
    moved = cols.move_column(typed, "d", 1)
    assert moved.columns == ["a", "d", "b", "c"]
    filled = cols.fill_null_zero(spark.createDataFrame([(None, None)], "s string, n bigint"))
    assert tuple(filled.first()) == ("0", 0)
    assert cols.drop_columns(norm, ["c", "d"]).columns == ["a", "b"]
    cast = cols.cast_columns(df.select("d"), {"D": "string"})
    assert dict(cast.dtypes) == {"d": "string"}


def test_iso_calendar_matches_the_standard_library(spark):
    """ISO week / year and the Monday of (week, ISO year) for every day of
    1994-2030 equal Python's ``isocalendar`` / ``fromisocalendar``."""
    start = dt.date(1994, 1, 1)
    n = (dt.date(2030, 12, 31) - start).days + 1
    days = spark.range(n).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("d"))
    got = days.select("d", cal.iso_week("d").alias("w"), cal.iso_year("d").alias("y"),
                      cal.iso_week_monday(cal.iso_week("d"), cal.iso_year("d")).alias("m")).collect()
    assert len(got) == n
    for r in got:
        y, w, _ = r.d.isocalendar()
        assert (r.y, r.w, r.m) == (y, w, dt.date.fromisocalendar(y, w, 1))
