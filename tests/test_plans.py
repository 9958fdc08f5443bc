"""Plan-shape checks that matter at scale, on the reports as planned over the
test mart with broadcasts disabled (every join shuffled, as at 100 TB)."""

from __future__ import annotations

import re

import pytest

from trafficlens.params import ReportParams
from trafficlens.plans.catalog import mart
from trafficlens.plans.reports import REPORTS

SF = "/root/testdata/sf0.001"
P = ReportParams.for_testdata()


@pytest.fixture()
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_report_plan_is_jvm_only_and_pairwise_free(spark, no_broadcast, name):
    plan = physical(REPORTS[name](mart(spark, SF), P))
    assert not re.search(r"(BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas)", plan)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["report_phone_clicks", "report_mortgage", "report_claims",
                                  "report_registrations", "report_deal_clicks"])
def test_event_side_is_pre_aggregated_before_the_join_shuffle(spark, no_broadcast, name):
    """The event side reaches the join as (session, key) aggregates whose partial
    step runs before the first shuffle, so a hot session collapses map-side."""
    plan = physical(REPORTS[name](mart(spark, SF), P))
    # a partial aggregate keyed on the session id sits directly above the event scan's filter
    assert re.search(r"HashAggregate\(keys=\[dimension4#\d+", plan), plan


def test_retention_shuffles_traffic_once(spark, no_broadcast):
    plan = physical(REPORTS["report_retention"](mart(spark, SF), P))
    # one fixed-width aggregate per user (week mask + first date), no join at all
    assert "Join" not in plan
    assert "bit_or" in plan and "ObjectHashAggregate" not in plan


def test_year_filter_is_a_pushed_range(spark):
    df = REPORTS["report_monthly_users"](mart(spark, SF), P)
    text = df._jdf.queryExecution().optimizedPlan().toString()
    assert "year(" not in text


@pytest.mark.parametrize("name", [n for n in sorted(REPORTS) if n not in (
    "report_monthly_users", "report_weekly_cost", "report_retention", "report_banners")])
def test_every_scan_of_a_session_or_event_report_prunes_partitions(spark, no_broadcast, name):
    scans = re.findall(r"FileScan .*", physical(REPORTS[name](mart(spark, SF), P)))
    assert scans
    for scan in scans:
        assert re.search(r"PartitionFilters: \[isnotnull\(date", scan), scan


def test_traffic_and_cost_bounds_are_pushed(spark):
    for name in ("report_retention", "report_weekly_cost"):
        assert re.search(r"PushedFilters: \[.*IsNotNull\(date\)", physical(REPORTS[name](mart(spark, SF), P)))


def test_no_static_broadcast_hints_in_reports(spark):
    for name, fn in REPORTS.items():
        text = fn(mart(spark, SF), P)._jdf.queryExecution().logical().toString()
        assert "broadcast" not in text.lower(), name


@pytest.mark.parametrize("name, most", [("report_deal_users", 6), ("report_deal_clicks", 4), ("report_deal_combined", 10)])
def test_deal_reports_shuffle_no_more_than(spark, no_broadcast, name, most):
    df = REPORTS[name](mart(spark, SF), P)
    df.collect()
    final = physical(df).split("== Initial Plan ==")[0]
    assert len(re.findall(r"\bExchange (?:hash|range|Single|RoundRobin)", final)) <= most
