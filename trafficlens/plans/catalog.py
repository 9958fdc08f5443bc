"""Query catalog: one entry per SURVEY section-2 key.

Each entry is ``fn(spark, sf_dir) -> DataFrame`` over the whole derived test
tables (``Mart.from_testdata``) with ``ReportParams.for_testdata()``. The
matching DuckDB SQL lives in ``trafficlens.oracle`` under the same key.
"""

from __future__ import annotations

import datetime as dt
import threading
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficlens.functions import calendar as cal
from trafficlens.functions import columns as cols
from trafficlens.functions import tagging as tag
from trafficlens.operators import aggregates as agg
from trafficlens.operators import filters as flt
from trafficlens.operators import joins as jn
from trafficlens.operators import retention as ret
from trafficlens.operators.cleanup import purify_banners, purify_calls
from trafficlens.params import TESTDATA_LOADED_UNTIL, ReportParams
from trafficlens.plans import reports as rp
from trafficlens.plans.registry import publish_all
from trafficlens.session import ensure_required_conf, scratch_path
from trafficlens.sinks import writers
from trafficlens.sources import fixtures
from trafficlens.sources.mart import Mart
from trafficlens.sources.report_api import flatten_report, read_report_pages
from trafficlens.sources.schemas import LOADED_BANNERS, REPORT_PAGE
from trafficlens.streaming import incremental as inc
from trafficlens.streaming.cohort_state import CohortState, cohort_traffic
from trafficlens.streaming.distinct_state import DistinctState
from trafficlens.streaming.ledger import wanted_windows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

P = ReportParams.for_testdata()


def query(key: str):
    def register(fn):
        QUERIES[key] = fn
        return fn
    return register


_MARTS: dict[tuple[int, str, str], Mart] = {}
_MARTS_LOCK = threading.Lock()


def mart(spark: SparkSession, sf_dir: str) -> Mart:
    """The mart over ``sf_dir``: derived from the test tables once per Spark
    application and written to the shared checkpoint folder in the production
    layout, so every query scans stored, date-partitioned tables."""
    ensure_required_conf(spark)
    cache_key = (id(spark), spark.sparkContext.applicationId, sf_dir)
    with _MARTS_LOCK:  # one write per mart, also when queries run from several threads
        if cache_key not in _MARTS:
            derived = fixtures.derive_tables(spark, sf_dir)
            _MARTS[cache_key] = Mart.written(spark, derived, scratch_path(spark, "mart"))
        return _MARTS[cache_key]


def _report(fn) -> Query:
    return lambda spark, sf_dir: fn(mart(spark, sf_dir), P)


# ------------------------------------------------------------------ reports
for _key, _fn in rp.REPORTS.items():
    QUERIES[_key] = _report(_fn)


@query("combine_by_position")
def _combine_by_position(spark, sf_dir):
    return rp.report_deal_combined(mart(spark, sf_dir), P.with_(combine_how="position"))


@query("combine_by_week")
def _combine_by_week(spark, sf_dir):
    return rp.report_deal_combined(mart(spark, sf_dir), P.with_(combine_how="key"))


# ------------------------------------------------------------------ sources S1-S7
for _name, _key in [("sessions", "scan_sessions"), ("raw_events", "scan_raw_events"),
                    ("page_views", "scan_page_views"), ("users_dim", "scan_users"),
                    ("traffic", "scan_traffic"), ("costs", "scan_costs")]:
    QUERIES[_key] = (lambda n: lambda spark, sf_dir: mart(spark, sf_dir).table(n))(_name)


@query("scan_banners")
def _scan_banners(spark, sf_dir):
    return flt.from_date(mart(spark, sf_dir).table("banners"), "date", P.banners_from)


# ------------------------------------------------------------------ report API S9-S14
def nested_banner_rows(m: Mart, first: str | None = None, last: str | None = None, p: ReportParams = P) -> DataFrame:
    """Banner hits that pass the report request's filter, as response records:
    one nested record per row, filed under its day. ``first`` / ``last`` bound the
    days and prune the table's partitions."""
    hits = m.table("banner_hits")
    if first is not None:
        hits = hits.where(F.col("date").between(first, last))
    hits = flt.filter_expr(hits, flt.parse_filter_expression(p.banner_filter))
    dims = [F.col("isoweek"), F.date_format(cal.parse_iso_date("date"), "yyyyMMdd"),
            F.col("eventlabel"), F.col("eventcategory"), F.col("eventaction")]
    mets = [F.col("totalevents"), F.col("users").cast("string")]
    header = F.struct(
        F.array(*map(F.lit, p.banner_dimensions)).alias("dimensions"),
        F.struct(F.array(*[F.struct(F.lit(n).alias("name"), F.lit("INTEGER").alias("type")) for n in p.banner_metrics])
                 .alias("metricHeaderEntries")).alias("metricHeader"))
    row = F.struct(F.array(*dims).alias("dimensions"), F.array(F.struct(F.array(*mets).alias("values"))).alias("metrics"))
    body = F.array(F.struct(header.alias("columnHeader"), F.struct(F.array(row).alias("rows")).alias("data")))
    record = {"startDate": F.col("date"), "endDate": F.col("date"), "reports": body}
    return hits.select(*[record[f.name].alias(f.name) for f in REPORT_PAGE.fields if f.name in record])


def banner_windows(m: Mart, p: ReportParams = P) -> DataFrame:
    """Request windows over the banner table's date span."""
    d = cal.parse_iso_date("date")
    bounds = m.table("banners", ["date"]).agg(F.min(d).alias("start_date"), F.max(d).alias("end_date"))
    return inc.windows_between(bounds, p.window_step_days)


@query("flatten_report")
def _flatten_report(spark, sf_dir):
    flat = flatten_report(nested_banner_rows(mart(spark, sf_dir)), P.banner_dimensions, P.banner_metrics)
    return cols.normalize_columns(flat, prefix="ga:")


@query("flatten_report_empty")
def _flatten_report_empty(spark, sf_dir):
    """Records of days without rows carry no row list and add nothing; the
    columns stay. Here every second day's rows are taken out."""
    pages = nested_banner_rows(mart(spark, sf_dir))
    body = F.col("reports")[0]
    odd = F.day(cal.parse_iso_date("startDate")) % 2 == 1
    emptied = F.array(F.struct(body["columnHeader"].alias("columnHeader"), F.struct(
        F.when(~odd, body["data"]["rows"]).alias("rows")).alias("data")))
    flat = flatten_report(pages.withColumn("reports", emptied), P.banner_dimensions, P.banner_metrics)
    return cols.normalize_columns(flat, prefix="ga:")


@query("report_union_windows")
def _report_union_windows(spark, sf_dir):
    """Each day's records land in their own folder; one read unions them all."""
    root = scratch_path(spark, "windows")
    nested_banner_rows(mart(spark, sf_dir)).write.partitionBy("startDate").json(root)
    flat = flatten_report(read_report_pages(spark, root), P.banner_dimensions, P.banner_metrics)
    return cols.normalize_columns(flat, prefix="ga:")


@query("source_filter")
def _source_filter(spark, sf_dir):
    ev = mart(spark, sf_dir).table("raw_events")
    return flt.filter_expr(ev, flt.parse_filter_expression("ga:pagepath=~/nedvizhimost;ga:eventLabel=~click"))


# ------------------------------------------------------------------ sinks K1-K4
def _banner_target(spark: SparkSession) -> str:
    return scratch_path(spark, "banners-target")


@query("append_banners")
def _append_banners(spark, sf_dir):
    """Two appends with different rows of the same dates: both stay."""
    target = _banner_target(spark)
    rows = inc.typed_report_rows(nested_banner_rows(mart(spark, sf_dir)), P.banner_dimensions, P.banner_metrics)
    serp = F.lower("eventLabel").contains("serp")
    writers.append(rows.where(serp), target)
    writers.append(rows.where(~serp), target)
    return spark.read.schema(LOADED_BANNERS).parquet(target)


@query("replace_temp_view")
def _replace_temp_view(spark, sf_dir):
    writers.as_view(mart(spark, sf_dir).table("sessions"), "trafficlens_banner_view")
    writers.as_view(mart(spark, sf_dir).table("banners"), "trafficlens_banner_view")  # replaces the first
    return spark.sql("SELECT isoweek, eventlabel, users FROM trafficlens_banner_view WHERE users > 1")


@query("report_matrix")
def _report_matrix(spark, sf_dir):
    df = rp.report_vas_by_city(mart(spark, sf_dir), P)
    return writers.report_matrix(df, ["isoweek", "city", "tot", "un"])


@query("publish_registry")
def _publish_registry(spark, sf_dir):
    return publish_all(mart(spark, sf_dir), P, scratch_path(spark, "published"))


# ------------------------------------------------------------------ projections P1-P22
@query("cast_date")
def _cast_date(spark, sf_dir):
    ev = mart(spark, sf_dir).table("raw_events", ["dimension4", "dateHourMinute"])
    return ev.select("dimension4", "dateHourMinute", cal.to_date_col("dateHourMinute").alias("event_date"))


@query("cast_datetime")
def _cast_datetime(spark, sf_dir):
    s = mart(spark, sf_dir).table("sessions", ["session_id", "date"])
    return s.select("session_id", "date", cal.to_datetime_col("date").alias("session_dt"))


@query("iso_week")
def _iso_week(spark, sf_dir):
    t = mart(spark, sf_dir).table("traffic", ["date", "dimension1"])  # several years
    return t.select("date", "dimension1", cal.iso_week("date").alias("isoweek"))


@query("iso_week_pd")
def _iso_week_pd(spark, sf_dir):
    c = mart(spark, sf_dir).table("costs", ["date", "CITY"])
    text = F.col("date").cast("string")
    return c.select(text.alias("date"), "CITY", cal.iso_week(cal.parse_iso_date(text)).alias("week"))


@query("month_of")
def _month_of(spark, sf_dir):
    s = mart(spark, sf_dir).table("sessions", ["session_id", "date"])
    return s.select("session_id", "date", cal.month_of("date").alias("month"))


@query("year_of")
def _year_of(spark, sf_dir):
    t = mart(spark, sf_dir).table("traffic", ["date", "dimension1"])
    return t.select("date", "dimension1", cal.year_of("date").alias("year"))


@query("iso_week_monday")
def _iso_week_monday(spark, sf_dir):
    """Monday of each cost date's ISO week, from (week, ISO year)."""
    c = mart(spark, sf_dir).table("costs", ["date", "CITY"])
    return c.select("date", "CITY", cal.iso_week("date").alias("isoweek"),
                    cal.iso_week_monday(cal.iso_week("date"), cal.iso_year("date")).alias("start_week"))


@query("city_bucket")
def _city_bucket(spark, sf_dir):
    ev = mart(spark, sf_dir).table("raw_events", ["dimension4", "pagepath"])
    return ev.select("dimension4", "pagepath", tag.city_bucket("pagepath", "REG").alias("city"),
                     tag.city_bucket("pagepath", "0").alias("city0"))


@query("cohort_year")
def _cohort_year(spark, sf_dir):
    t = mart(spark, sf_dir).table("traffic", ["date", "dimension1"])
    return t.select("date", "dimension1", ret.cohort_year("date", P.retention_week52_year).alias("year"))


@query("cohort_age")
def _cohort_age(spark, sf_dir):
    """Age of each traffic date's week relative to the week 90 days earlier
    (crosses the year end, so the wrap is exercised)."""
    t = mart(spark, sf_dir).table("traffic", ["date", "dimension1"])
    return t.select("date", "dimension1",
                    ret.cohort_age(cal.iso_week("date"), cal.iso_week(F.date_sub("date", 90))).alias("senior"))


@query("regex_prefix")
def _regex_prefix(spark, sf_dir):
    ev = mart(spark, sf_dir).table("raw_events", ["dimension4", "eventaction"])
    return ev.select("dimension4", "eventaction", tag.regex_prefix("eventaction").alias("prefix"))


@query("length_positive")
def _length_positive(spark, sf_dir):
    ev = mart(spark, sf_dir).table("raw_events", ["dimension4", "eventaction"])
    pre = tag.regex_prefix("eventaction")
    return ev.where(tag.length_positive(pre)).select("dimension4", "eventaction", pre.alias("prefix"))


@query("round2")
def _round2(spark, sf_dir):
    c = mart(spark, sf_dir).table("costs", ["date", "CITY", "COSTS"])
    half = c["COSTS"].cast("decimal(18,4)") * F.lit(Decimal("0.5"))
    return c.select("date", "CITY", cols.round2(half).cast("double").alias("half_cost"))


@query("lower_contains")
def _lower_contains(spark, sf_dir):
    b = mart(spark, sf_dir).table("banners", ["date", "eventlabel"])
    return b.select("date", "eventlabel", tag.lower_contains("eventlabel", "serp").alias("has_serp"))


@query("normalize_columns")
def _normalize_columns(spark, sf_dir):
    ev = mart(spark, sf_dir).table("raw_events")
    prefixed = ev.toDF(*[f"ga:{c}" for c in ev.columns])
    return cols.normalize_columns(prefixed, prefix="ga:", lower=True)


@query("parse_compact_date")
def _parse_compact_date(spark, sf_dir):
    b = mart(spark, sf_dir).table("banners", ["date", "eventlabel"])
    compact = F.regexp_replace("date", "-", "")
    return b.select(compact.alias("compact"), "eventlabel", cal.parse_compact_date(compact).alias("parsed"))


@query("cast_metrics")
def _cast_metrics(spark, sf_dir):
    b = mart(spark, sf_dir).table("banners", ["date", "eventlabel", "totalevents", "users"])
    return cols.cast_metrics(b, ["totalevents", "users"])


@query("cast_float_string")
def _cast_float_string(spark, sf_dir):
    c = mart(spark, sf_dir).table("costs")
    return cols.cast_columns(c, {"COSTS": "double", "CITY": "string", "date": "string"})


@query("parse_iso_date")
def _parse_iso_date(spark, sf_dir):
    b = mart(spark, sf_dir).table("banners", ["date", "eventlabel"])
    return b.select("eventlabel", cal.parse_iso_date("date").alias("parsed"))


@query("reorder_columns")
def _reorder_columns(spark, sf_dir):
    return cols.move_column(mart(spark, sf_dir).table("costs"), "COSTS", 1)


@query("drop_columns")
def _drop_columns(spark, sf_dir):
    return cols.drop_columns(mart(spark, sf_dir).table("banners"), ["eventcategory", "eventaction"])


@query("fill_null_zero")
def _fill_null_zero(spark, sf_dir):
    ev = mart(spark, sf_dir).table("raw_events", ["dateHourMinute", "dimension4", "eventlabel", "totalEvents"])
    return cols.fill_null_zero(ev)


# ------------------------------------------------------------------ filters F1-F15
@query("filter_date_from")
def _filter_date_from(spark, sf_dir):
    return flt.from_date(mart(spark, sf_dir).table("sessions"), "date", P.start_date)


@query("filter_ts_from")
def _filter_ts_from(spark, sf_dir):
    return flt.from_ts(mart(spark, sf_dir).table("raw_events"), "dateHourMinute", P.lead_from_ts)


@query("filter_date_after")
def _filter_date_after(spark, sf_dir):
    return flt.after_date(mart(spark, sf_dir).table("traffic"), "date", P.retention_after)


@query("filter_like")
def _filter_like(spark, sf_dir):
    return flt.url_contains(mart(spark, sf_dir).table("sessions"), "landingpage", P.section)


@query("filter_not_like")
def _filter_not_like(spark, sf_dir):
    return flt.url_excludes(mart(spark, sf_dir).table("sessions"), "landingpage", P.test_host)


@query("filter_not_equal")
def _filter_not_equal(spark, sf_dir):
    return flt.not_equal(mart(spark, sf_dir).table("users_dim"), "dimension2", "not_authorized")


@query("filter_regex_any")
def _filter_regex_any(spark, sf_dir):
    return flt.regex_any(mart(spark, sf_dir).table("raw_events"), "eventlabel", P.phone_click_labels)


@query("filter_regex_anchored")
def _filter_regex_anchored(spark, sf_dir):
    return flt.regex_any(mart(spark, sf_dir).table("raw_events"), "eventlabel", P.mortgage_labels)


@query("filter_equal_or")
def _filter_equal_or(spark, sf_dir):
    return flt.equals_any(mart(spark, sf_dir).table("raw_events"), "eventlabel", P.vas_labels)


@query("filter_post_join_not_null")
def _filter_post_join_not_null(spark, sf_dir):
    m = mart(spark, sf_dir)
    s = m.table("sessions", ["session_id", "user_id"])
    ev = m.table("raw_events", ["dimension4", "eventlabel", "totalEvents"])
    joined = s.join(ev, s["session_id"] == ev["dimension4"], "left")
    return flt.not_null(joined, "eventlabel").select("session_id", "user_id", "eventlabel", "totalEvents")


@query("filter_positive")
def _filter_positive(spark, sf_dir):
    return flt.positive(mart(spark, sf_dir).table("costs"), "COSTS")


@query("filter_year")
def _filter_year(spark, sf_dir):
    return flt.in_year(mart(spark, sf_dir).table("traffic"), "date", P.cost_week_year)


@query("having_positive")
def _having_positive(spark, sf_dir):
    ev = mart(spark, sf_dir).table("raw_events", ["dimension4", "eventlabel"])
    counted = agg.agg_distinct(ev, ["dimension4"], "eventlabel", "labels")
    return flt.having_positive(counted, "labels")


@query("filter_tagged")
def _filter_tagged(spark, sf_dir):
    b = mart(spark, sf_dir).table("banners")
    return flt.not_null(b.withColumn("product", tag.tag_product("eventlabel")), "product")


@query("filter_null_week")
def _filter_null_week(spark, sf_dir):
    return flt.not_null(mart(spark, sf_dir).table("banners"), "isoweek")


# ------------------------------------------------------------------ joins J1-J5
@query("join_right_sessions_events")
def _join_right(spark, sf_dir):
    m = mart(spark, sf_dir)
    s = agg.dedupe(m.table("sessions"), ["session_id", "user_id"])
    ev = m.table("raw_events", ["dimension4", "eventlabel", "totalEvents"])
    return jn.join_events(s, ev, how="right", require="user_id").select(
        "session_id", "user_id", "eventlabel", "totalEvents")


@query("join_left_sessions_events")
def _join_left(spark, sf_dir):
    m = mart(spark, sf_dir)
    s = m.table("sessions", ["date", "session_id", "utm_campaign"])
    ev = m.table("raw_events", ["dimension4", "eventlabel", "totalEvents"])
    return jn.join_events(s, ev, how="left", require="eventlabel").select(
        "date", "session_id", "utm_campaign", "eventlabel", "totalEvents")


@query("join_session_week")
def _join_session_week(spark, sf_dir):
    m = mart(spark, sf_dir)
    s = m.table("sessions").select(cal.iso_week("date").alias("isoweek"), "session_id", "user_id").distinct()
    ev = m.table("raw_events").select(cal.iso_week(F.col("dateHourMinute").cast("date")).alias("isoweek"),
                                      "dimension4", "eventlabel", "users")
    return jn.join_events(s, ev, how="left", require="eventlabel", on_week="isoweek").select(
        "isoweek", "session_id", "user_id", "eventlabel", "users")


@query("join_three_way_left")
def _join_three_way_left(spark, sf_dir):
    m = mart(spark, sf_dir)
    views = m.table("page_views").select(F.col("dateHourMinute").cast("date").alias("date"), "dimension4").distinct()
    sess = m.table("sessions").select("date", "session_id", "user_id").distinct()
    users = m.table("users_dim").select("date", "dimension1", "dimension2").distinct()
    chained = jn.chain_left(views, sess, users)
    return chained.select("date", "dimension4", F.col("s_user_id").alias("user_id"),
                          F.col("u_dimension2").alias("dimension2"))


@query("join_cohort_activity")
def _join_cohort_activity(spark, sf_dir):
    t = mart(spark, sf_dir).table("traffic")
    t = flt.after_date(flt.url_contains(t, "landingpagepath", P.section), "date", P.retention_after)
    return jn.join_cohort(ret.weekly_activity(t), ret.first_week(t, week52_year=P.retention_week52_year))


# ------------------------------------------------------------------ aggregates A1-A11
@query("agg_sum")
def _agg_sum(spark, sf_dir):
    ev = mart(spark, sf_dir).table("raw_events")
    return agg.agg_sum(ev, ["eventlabel"], {"tot": "totalEvents", "users": "users"})


@query("agg_count_distinct")
def _agg_count_distinct(spark, sf_dir):
    return agg.agg_distinct(mart(spark, sf_dir).table("sessions"), ["date"], "user_id", "uniqs")


@query("agg_sum_and_distinct")
def _agg_sum_and_distinct(spark, sf_dir):
    ev = mart(spark, sf_dir).table("raw_events")
    ev = ev.withColumn("isoweek", cal.iso_week("dateHourMinute"))
    return agg.agg_sum_distinct(ev, ["isoweek"], "totalEvents", "totalEvents", "dimension4", "sessions")


@query("agg_first_week")
def _agg_first_week(spark, sf_dir):
    t = flt.url_contains(mart(spark, sf_dir).table("traffic"), "landingpagepath", P.section)
    return ret.first_week(t, week52_year=P.retention_week52_year)


@query("agg_max_date")
def _agg_max_date(spark, sf_dir):
    return agg.max_date(mart(spark, sf_dir).table("sessions"), "date")


@query("agg_cohort_pivot")
def _agg_cohort_pivot(spark, sf_dir):
    """The 53-column pivot over all traffic (no section or date filter)."""
    return ret.retention_matrix(mart(spark, sf_dir).table("traffic"), P.retention_week52_year)


@query("agg_dedupe")
def _agg_dedupe(spark, sf_dir):
    pv = mart(spark, sf_dir).table("page_views")
    return agg.dedupe(pv.withColumn("date", F.col("dateHourMinute").cast("date")), ["date", "dimension4"])


@query("agg_group_by_expr")
def _agg_group_by_expr(spark, sf_dir):
    ev = mart(spark, sf_dir).table("raw_events")
    return agg.agg_by(ev, {"city": tag.city_bucket("pagepath", "REG"),
                           "prefix": tag.regex_prefix("eventaction")},
                      [agg.sum_as_bigint("totalEvents").alias("tot")])


@query("agg_second_level")
def _agg_second_level(spark, sf_dir):
    ev = mart(spark, sf_dir).table("raw_events")
    return agg.second_level(ev, ["eventlabel", "eventcategory"],
                            {"tot_event": "totalEvents", "u_event": "uniqueEvents"})


@query("agg_four_keys")
def _agg_four_keys(spark, sf_dir):
    b = purify_banners(mart(spark, sf_dir).table("banners"))
    return agg.agg_sum(b, ["isoweek", "product", "action_type", "card_serp"],
                       {"bnrs": "totalevents", "un_users": "users"})


@query("agg_rounded_sum")
def _agg_rounded_sum(spark, sf_dir):
    c = mart(spark, sf_dir).table("costs")
    return c.groupBy("CITY").agg(agg.rounded_sum("COSTS").alias("COST"))


# ------------------------------------------------------------------ sorts O1-O2
@query("sort_one_key")
def _sort_one_key(spark, sf_dir):
    return agg.sort_by(mart(spark, sf_dir).table("costs"), "date")


@query("sort_multi_key")
def _sort_multi_key(spark, sf_dir):
    return agg.sort_by(mart(spark, sf_dir).table("costs"), "CITY", "date")


# ------------------------------------------------------------------ tagging U1-U7
@query("tag_campaign")
def _tag_campaign(spark, sf_dir):
    s = mart(spark, sf_dir).table("sessions", ["session_id", "utm_campaign"])
    return s.select("session_id", "utm_campaign", tag.campaign_type("utm_campaign").alias("cpc_type"))


def _banner_tag(fn, alias):
    def run(spark, sf_dir):
        b = mart(spark, sf_dir).table("banners", ["date", "eventlabel"])
        return b.select("date", "eventlabel", fn("eventlabel").alias(alias))
    return run


QUERIES["tag_location"] = _banner_tag(tag.tag_location, "card_serp")
QUERIES["tag_product"] = _banner_tag(tag.tag_product, "product")
QUERIES["tag_action"] = _banner_tag(tag.tag_action, "action_type")


@query("tag_geo")
def _tag_geo(spark, sf_dir):
    s = mart(spark, sf_dir).table("sessions", ["session_id", "landingpage"])
    return s.select("session_id", "landingpage", tag.tag_geo("landingpage").alias("geo"))


def calls_day_grain(m: Mart, p: ReportParams = P) -> DataFrame:
    """R2's first stage: the warehouse query at day grain. Both sides are cut to
    the grain of the result before they meet: sessions to their row count ``n``
    per (session, date, campaign), events to sums per (session, city, page, label)."""
    tr = flt.from_date(m.table("sessions", ["date", "utm_campaign", "session_id"]), "date", p.start_date)
    tr = rp.session_multiplicity(tr, "date", "utm_campaign")
    ev = m.table("raw_events", ["date", "dateHourMinute", "pagepath", "eventlabel", "uniqueEvents", "totalEvents",
                                "dimension4"])
    ev = flt.regex_any(flt.from_date(ev, "dateHourMinute", p.start_date), "eventlabel", p.call_labels)
    ev = ev.groupBy("dimension4", "pagepath", "eventlabel").agg(
        F.sum("uniqueEvents").alias("uniqueEvents"), F.sum("totalEvents").alias("totalEvents"))
    joined = jn.join_events(tr, ev, how="left", require="eventlabel")
    n = F.col("n")
    return joined.groupBy("date", tag.city_bucket("pagepath", "0").alias("city"), "pagepath", "eventlabel",
                          "utm_campaign").agg(
        agg.sum_as_bigint(n * F.col("uniqueEvents")).alias("uniqueEvents"),
        agg.sum_as_bigint(n * F.col("totalEvents")).alias("totalEvents"))


@query("purify_calls")
def _purify_calls(spark, sf_dir):
    return purify_calls(calls_day_grain(mart(spark, sf_dir)))


@query("purify_banners")
def _purify_banners(spark, sf_dir):
    return purify_banners(mart(spark, sf_dir).table("banners"))


# ------------------------------------------------------------------ incremental I1-I3
@query("high_water_mark")
def _high_water_mark(spark, sf_dir):
    return inc.high_water_mark(mart(spark, sf_dir).table("banners"), P.load_default_start, P.load_today)


@query("date_windows")
def _date_windows(spark, sf_dir):
    return banner_windows(mart(spark, sf_dir))


@query("incremental_append")
def _incremental_append(spark, sf_dir):
    """Two loads into a fresh target: the first fills dates before the
    cut-off, the second starts at its high-water mark and runs to yesterday.
    Returns the whole target table."""
    m = mart(spark, sf_dir)
    target = _banner_target(spark)

    def fetch(windows: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
        return nested_banner_rows(m, first.isoformat(), last.isoformat())

    for today in (TESTDATA_LOADED_UNTIL, P.load_today):
        inc.incremental_append(spark, target, fetch, P.banner_dimensions, P.banner_metrics,
                               default_start=P.load_default_start, today=today, step=P.window_step_days)
    return spark.read.schema(LOADED_BANNERS).parquet(target)


@query("cohort_state")
def _cohort_state(spark, sf_dir):
    """R13 from the per-user state, after merges of all traffic out of order: the
    later years first, then the earlier ones, then some days again."""
    traffic = cohort_traffic(mart(spark, sf_dir).table("traffic", ["date", "dimension1", "landingpagepath"]), P)
    state = CohortState(spark, scratch_path(spark, "cohort-state"), buckets=8)
    late = F.year("date") >= 1998
    for part, rows in (("late", traffic.where(late)), ("early", traffic.where(~late)),
                       ("again", traffic.where(F.month("date") == 5))):
        state.merge(rows, part)
    return state.retention(P)


@query("report_retention_exact")
def _report_retention_exact(spark, sf_dir):
    """R13 with exact ages: cohorts of every year apart, ages up to three years."""
    return rp.report_retention(mart(spark, sf_dir), P.with_(retention_exact_weeks=True, retention_max_age=156))


@query("distinct_state")
def _distinct_state(spark, sf_dir):
    """R11 from the bitmaps of days, after merges of all sessions out of order: the
    later half of each month first, then the earlier one, then some days again."""
    sessions = rp.section_sessions(mart(spark, sf_dir), P)
    state = DistinctState(spark, scratch_path(spark, "distinct-state"), buckets=8)
    late = F.dayofmonth("date") > 15
    for rows in (sessions.where(late), sessions.where(~late), sessions.where(F.dayofmonth("date") == 7)):
        state.merge(rows, "user_id")
    return rp.monthly_users_of(state, P)


@query("window_ledger")
def _window_ledger(spark, sf_dir):
    """Windows to ask for, over the days of the traffic table as one-day loads: a day
    with under half of the mean rows of a day counts as incomplete."""
    t = mart(spark, sf_dir).table("traffic", ["date"])
    days = t.where(F.col("date").isNotNull()).groupBy("date").agg(F.count(F.lit(1)).alias("n"))
    whole = days.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("days"),
                     F.min("date").alias("first"), F.max("date").alias("last")).first()  # one row
    null = F.lit(None)
    ledger = days.select(
        F.col("date").alias("window_start"), F.col("date").alias("window_end"), F.lit("loaded").alias("state"),
        F.col("n").alias("rows"), null.cast("long").alias("expected_rows"),
        (F.col("n") * 2 * F.lit(whole["days"]) >= F.lit(whole["rows"])).alias("complete"), F.lit(True).alias("golden"),
        null.cast("timestamp").alias("newest_landing"), F.lit("days").alias("load_id"), F.lit(1).cast("long").alias("step"))
    if whole["first"] is None:  # no days, no windows
        return wanted_windows(ledger, "2024-01-02", "2024-01-01", P.window_step_days)
    return wanted_windows(ledger, whole["first"], whole["last"], P.window_step_days)


def queries() -> dict[str, Query]:
    return dict(QUERIES)


# Keys checked by row count only (no SQL oracle): none -- every key has one.
ROWS_ONLY: tuple[str, ...] = ()

__all__ = ["queries", "QUERIES", "ROWS_ONLY", "mart", "P"]
