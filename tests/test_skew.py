"""Skew: one session id holds a third of all session rows and events.

Inline test frames (not registered queries). Each report is compared with the
DuckDB oracle SQL run by brute force over the same rows, and the plans are
checked for the mechanism that keeps the hot key off a single task: map-side
collapse (pre-aggregation with a multiplicity) or an AQE skew-split join.
"""

from __future__ import annotations

import datetime as dt
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from scripts.check_oracle import digest
from trafficlens import oracle
from trafficlens.params import ReportParams
from trafficlens.plans.reports import REPORTS
from trafficlens.sources.mart import Mart

P = ReportParams.for_testdata()
N = 30_000
SKEW_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture(scope="module")
def skewed(spark):
    base = dt.date(2024, 1, 3)
    ids = spark.range(N)
    sid = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 2000).cast("string"))
    # session ids are per day (as in the mart), so the hot session is one day's key
    day = F.when(F.col("id") % 3 == 0, F.lit(base)).otherwise(F.date_add(F.lit(base), (F.col("id") % 28).cast("int")))
    ts = F.to_timestamp_ntz(F.concat(day.cast("string"), F.lit(" 12:00:00")))
    sessions = ids.select(day.alias("date"), sid.alias("session_id"), F.col("id").cast("string").alias("user_id"),
                          F.lit("https://h.example/moskva/nedvizhimost").alias("landingpage"),
                          F.lit("google").alias("utm_source"), F.lit("cpc").alias("utm_medium"),
                          F.lit("second_msk").alias("utm_campaign"))
    k = F.col("id") % 5
    label = F.when(k == 0, "ClCardSellPhoneClickTop").when(k == 1, "claim_completed") \
             .when(k == 2, "ClCardSellMortgageClick").when(k == 3, "NewRegSuccess") \
             .otherwise("lk_onlinebuy_lp_header_buy_click")
    events = ids.select(day.alias("date"), ts.alias("dateHourMinute"), sid.alias("dimension4"), label.alias("eventlabel"),
                        F.lit("FL").alias("eventcategory"), F.lit("act1_x").alias("eventaction"),
                        F.lit("/moskva/nedvizhimost").alias("pagepath"), F.lit(1).cast("bigint").alias("totalEvents"),
                        F.lit(1).cast("bigint").alias("uniqueEvents"), F.lit(1).cast("bigint").alias("users"))
    views = ids.select(day.alias("date"), ts.alias("dateHourMinute"), sid.alias("dimension4"),
                       F.when(F.col("id") % 2 == 0, "/services/deal/x").otherwise("/guaranteed-deal").alias("pagepath"))
    users = ids.select(day.alias("date"), F.col("id").cast("string").alias("dimension1"),
                       F.lit("authorized").alias("dimension2"))
    frames = {"sessions": sessions, "raw_events": events, "page_views": views, "users_dim": users}
    con = duckdb.connect()
    for name, df in frames.items():
        con.register(name, df.toPandas())
    return Mart(frames), con


@pytest.fixture()
def skew_conf(spark):
    old = {k: spark.conf.get(k) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


ORACLE = {
    "report_phone_clicks": oracle.r1, "report_calls_by_campaign": oracle.r2, "report_mortgage": oracle.r4,
    "report_claims": oracle.r5, "report_registrations": lambda: oracle.r6(False),
    "report_deal_users": lambda: oracle.r9(P.deal_page, "od_us"),
    "report_deal_clicks": lambda: oracle.r8(P.deal_click_label, "od_clicks"),
}


def final_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_hot_session_results_match_brute_force(spark, skewed, skew_conf, name):
    m, con = skewed
    df = REPORTS[name](m, P)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(f"SELECT * FROM ({ORACLE[name]()}) q")
    want_cols = [c[0] for c in cur.description]
    want = cur.fetchall()
    assert len(got) == len(want) > 0
    assert digest(df.columns, got) == digest(want_cols, want)


@pytest.mark.parametrize("name", ["report_phone_clicks", "report_mortgage", "report_deal_users"])
def test_hot_session_join_is_split_by_aqe(spark, skewed, skew_conf, name):
    """Joins that must keep many distinct users per session reach the join as
    two plain shuffle stages, and AQE splits the hot partition."""
    m, _ = skewed
    df = REPORTS[name](m, P)
    df.collect()
    plan = final_plan(df)
    assert re.search(r"SortMergeJoin\(skew=true\)|isSkewJoin=true", plan), plan
    assert "AQEShuffleRead skewed" in plan


@pytest.mark.parametrize("name", ["report_claims", "report_registrations", "report_calls_by_campaign",
                                  "report_deal_clicks"])
def test_hot_session_collapses_before_the_shuffle(spark, skewed, skew_conf, name):
    """Sum-only reports carry the session fan-out as a count: the session side
    is partially aggregated on the session id before its first shuffle."""
    m, _ = skewed
    df = REPORTS[name](m, P)
    df.collect()
    plan = final_plan(df)
    assert re.search(r"HashAggregate\(keys=\[session_id#\d+", plan), plan
    assert "partial_count" in plan

