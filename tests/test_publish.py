"""Publishing (K3/K4, R16): one CSV per destination, header row, reference row order."""

from __future__ import annotations

import glob

import pytest

from trafficlens.params import ReportParams
from trafficlens.plans import reports as rp
from trafficlens.plans.catalog import mart
from trafficlens.plans.registry import DESTINATIONS, publish, publish_all, published
from trafficlens.session import local_path

SF = "/root/testdata/sf0.01"
P = ReportParams.for_testdata()


def read_lines(path):
    files = glob.glob(local_path(path) + "/part-*.csv")
    assert len(files) == 1
    with open(files[0], encoding="utf-8") as fh:
        return fh.read().splitlines()


def published_text(spark, root, version=None):
    """Report name -> the lines of its current files."""
    snapshot = published(spark, root, version)
    return {name: read_lines(snapshot.path(name)) for name in snapshot.members}


def test_published_matrix_has_header_and_reference_order(spark, scratch):
    m = mart(spark, SF)
    root = scratch("pub")
    for name in ("report_calls_by_campaign", "report_retention", "report_weekly_cost"):
        df = rp.REPORTS[name](m, P)
        lines = read_lines(publish(name, df, root))
        assert lines[0].split(",") == df.columns
        expected = [tuple(r) for r in rp.ordered(name, df).collect()]
        got = [tuple(x.split(",")) for x in lines[1:]]
        text = lambda v: (
            "" if v is None else f"{v:.2f}".rstrip("0").rstrip(".") if isinstance(v, float) else str(v))
        assert got == [tuple(map(text, row)) for row in expected]


def test_publish_all_covers_every_destination(spark, scratch):
    summary = publish_all(mart(spark, "/root/testdata/sf0.001"), P, scratch("all"))
    assert {r.report_name for r in summary.collect()} == set(DESTINATIONS)


def test_a_failing_report_leaves_every_old_output(spark, scratch, monkeypatch):
    m, root = mart(spark, "/root/testdata/sf0.001"), scratch("kept")
    publish_all(m, P, root)
    before = published_text(spark, root)
    broken = dict(rp.REPORTS)
    broken["report_banners"] = lambda mart, p: mart.table("banners").selectExpr("raise_error('no report') AS isoweek")
    monkeypatch.setattr(rp, "REPORTS", broken)
    with pytest.raises(Exception, match="no report"):
        publish_all(m, P.with_(start_date="2024-01-20"), root)
    assert published_text(spark, root) == before and set(before) == set(DESTINATIONS)


def test_sessions_without_a_campaign_keep_their_calls(spark):
    from pyspark.sql import functions as F
    m = mart(spark, SF)
    total = lambda x: sum(r.tot_event for r in rp.report_calls_by_campaign(x, P).collect())
    nulls = m.table("sessions").withColumn("utm_campaign", F.when(F.col("utm_campaign") != "brand", F.col("utm_campaign")))
    assert total(m.with_table("sessions", nulls)) == total(m) > 0
    assert "(no campaign)" in {r.cpc_type for r in rp.report_calls_by_campaign(m, P).collect()}


def test_reports_over_the_shared_event_table_equal_the_full_table(spark):
    from trafficlens.plans.registry import shared_event_table

    m = mart(spark, SF)
    shared = shared_event_table(m, P)
    assert shared.table("raw_events").count() < m.table("raw_events").count()
    for name, fn in rp.REPORTS.items():
        got = sorted(map(tuple, fn(shared, P).collect()), key=repr)
        want = sorted(map(tuple, fn(m, P).collect()), key=repr)
        assert got == want, name


def test_banner_reports_of_two_marts_built_concurrently(spark):
    from concurrent.futures import ThreadPoolExecutor

    small, big = mart(spark, "/root/testdata/sf0.001"), mart(spark, SF)
    want = [sorted(map(tuple, rp.report_banners(m, P).collect())) for m in (small, big)]
    with ThreadPoolExecutor(max_workers=2) as pool:
        got = list(pool.map(lambda m: sorted(map(tuple, rp.report_banners(m, P).collect())), [small, big] * 2))
    assert got == want * 2
