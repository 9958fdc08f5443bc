"""Tables bucketed by the session id: no exchange below the session joins, the same
reports, and plain reads where one session is hot."""

from __future__ import annotations

import re
import uuid

import pytest
from pyspark.sql import functions as F

from trafficlens.operators.joins import join_events
from trafficlens.params import ReportParams
from trafficlens.plans.catalog import mart
from trafficlens.plans.reports import REPORTS
from trafficlens.sources.bucketed import bucket_skew, with_bucketed, write_bucketed
from trafficlens.sources.mart import Mart

SF = "/root/testdata/sf0.001"
P = ReportParams.for_testdata()
BUCKETS = 4


def shuffles(df) -> int:
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return len(re.findall(r"\bExchange (?:hash|range|Single|RoundRobin)", final))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root, database = str(tmp_path_factory.mktemp("bucketed")), f"b{uuid.uuid4().hex[:8]}"
    plain = mart(spark, SF)
    write_bucketed(spark, {n: plain.table(n) for n in ("sessions", "raw_events", "page_views")}, database, root, BUCKETS)
    yield plain, with_bucketed(spark, plain, database, root), database, root
    spark.sql(f"DROP DATABASE {database} CASCADE")


@pytest.fixture()
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_session_join_has_no_exchange(spark, stored, no_broadcast):
    plain, bucketed, _, _ = stored

    def joined(m: Mart):
        events = m.table("raw_events", ["dimension4", "eventlabel", "users"])
        return join_events(m.table("sessions", ["session_id", "user_id"]), events, require="dimension4")

    assert shuffles(joined(plain)) == 2 and shuffles(joined(bucketed)) == 0
    assert joined(plain).exceptAll(joined(bucketed)).count() == joined(bucketed).exceptAll(joined(plain)).count() == 0


@pytest.mark.parametrize("name, fewer", [("report_claims", True), ("report_registrations", True),
                                         ("report_phone_clicks", True), ("report_deal_combined", False)])
def test_reports_equal_those_of_the_plain_tables(stored, no_broadcast, name, fewer):
    plain, bucketed, _, _ = stored
    a, b = REPORTS[name](plain, P), REPORTS[name](bucketed, P)
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert shuffles(b) < shuffles(a) if fewer else shuffles(b) <= shuffles(a)


def test_date_bounds_still_prune(stored):
    _, bucketed, _, _ = stored
    plan = bucketed.table("raw_events", ["date", "dimension4"]).where("date >= DATE'2024-01-03'")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*date#\d+ >= 2024-01-03", text)


def test_a_hot_session_is_read_plain(spark, stored, no_broadcast, tmp_path):
    plain, _, _, _ = stored
    root, database = str(tmp_path), f"h{uuid.uuid4().hex[:8]}"
    hot = plain.table("sessions").withColumn("session_id", F.when(F.col("session_id").isNotNull(), F.lit("hot")))
    write_bucketed(spark, {"sessions": hot, "raw_events": plain.table("raw_events")}, database, root, BUCKETS)
    assert bucket_skew(spark, root, "sessions") == pytest.approx(4.0, rel=0.2) and bucket_skew(spark, root, "raw_events") < 2
    m = with_bucketed(spark, plain, database, root, max_skew=2.0)
    assert "Bucketed: true" not in m.table("sessions")._jdf.queryExecution().executedPlan().toString()
    assert m.table("sessions").exceptAll(hot.select(*m.table("sessions").columns)).count() == 0
    events = m.table("raw_events", ["dimension4", "users"])
    assert shuffles(join_events(m.table("sessions", ["session_id"]), events, require="dimension4")) >= 1
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_an_empty_table_has_no_skew(spark, stored, tmp_path):
    plain, _, _, _ = stored
    root, database = str(tmp_path), f"e{uuid.uuid4().hex[:8]}"
    write_bucketed(spark, {"sessions": plain.table("sessions").limit(0)}, database, root, BUCKETS)
    assert bucket_skew(spark, root, "sessions") == 1.0
    assert with_bucketed(spark, plain, database, root).table("sessions").count() == 0
    spark.sql(f"DROP DATABASE {database} CASCADE")
