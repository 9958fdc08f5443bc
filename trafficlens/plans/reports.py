"""The composite reports.

Every report is ``report_x(mart, params) -> DataFrame`` and is one lazy plan:
filters and projections reach the parquet scans, each side of a join is
reduced to the join grain first (de-duplicated sessions; events
pre-aggregated per session and output key, which collapses a hot session
map-side), and the weekly outputs are small. Output columns and their order are
the reference's.

Reports are returned unordered; the reference's ``ORDER BY`` (``REPORT_ORDER``)
is applied where the order is consumed -- ``ordered()`` and the published
matrix -- so no report pays a range shuffle it does not need.

Fan-out is preserved where the reference has it: sessions are de-duplicated
before the event join only in R1, R8 and R9, so a session id with two rows
doubles its event sums in R2 and R4-R7.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficlens.functions.calendar import iso_week, iso_week_monday, iso_year, month_of
from trafficlens.functions.columns import cast_columns, fill_null_zero, move_column
from trafficlens.functions.tagging import campaign_type, city_bucket, length_positive, regex_prefix
from trafficlens.operators import filters as flt
from trafficlens.operators.aggregates import (distinct_count, rounded_sum, second_level,
                                              sort_by, sum_as_bigint)
from trafficlens.operators.cleanup import purify_banners
from trafficlens.operators.joins import combine_wide, join_events
from trafficlens.operators.retention import cohort_pivot, exact_members, retention_matrix
from trafficlens.params import DIRECT_SOURCE, NO_CAMPAIGN, NO_MEDIUM, NOT_AUTHORIZED, ReportParams
from trafficlens.sinks.writers import as_view
from trafficlens.sources.mart import Mart
from trafficlens.streaming.distinct_state import DistinctState


def _event_week(ts_col: str = "dateHourMinute"):
    return iso_week(F.col(ts_col).cast("date"))


def _weeks(p: ReportParams, c, week: str = "isoweek") -> list:
    """The week column of a report, and with ``with_iso_year`` the year it belongs
    to (``isoyear``), so that the same week of two years stays apart."""
    c = F.col(c) if isinstance(c, str) else c
    return [iso_week(c).alias(week), *([iso_year(c).alias("isoyear")] if p.with_iso_year else [])]


def _week_names(p: ReportParams, week: str = "isoweek") -> list[str]:
    return [week, *(["isoyear"] if p.with_iso_year else [])]


def session_multiplicity(sessions: DataFrame, *keys) -> DataFrame:
    """Sessions cut to (session_id, keys...) with ``n``, the number of session
    rows behind each: the join then multiplies event sums by ``n`` instead of
    repeating rows. A session id holding a large share of all rows collapses
    in the map-side partial aggregate before any shuffle."""
    return sessions.groupBy("session_id", *keys).agg(F.count(F.lit(1)).alias("n"))


# --------------------------------------------------------------------------- R1
def report_phone_clicks(mart: Mart, p: ReportParams) -> DataFrame:
    """Weekly phone-click events and distinct users of section sessions
    (non-direct). Columns: week, totalEvents, dimension1."""
    tr = mart.table("sessions", ["date", "session_id", "user_id", "landingpage", "utm_source"])
    tr = flt.from_date(tr, "date", p.start_date)
    tr = flt.url_contains(tr, "landingpage", p.section)
    tr = flt.not_equal(tr, "utm_source", DIRECT_SOURCE)
    tr = tr.select("session_id", "user_id").distinct()

    ev = mart.table("raw_events", ["date", "dateHourMinute", "dimension4", "eventlabel", "totalEvents"])
    ev = flt.regex_any(ev, "eventlabel", p.phone_click_labels)
    ev = flt.from_date(ev, "dateHourMinute", p.start_date)
    ev = flt.url_excludes(ev, "eventlabel", p.phone_click_excluded)
    ev = (ev.groupBy("dimension4", _event_week().alias("isoweek"))
            .agg(F.sum("totalEvents").alias("totalEvents")))

    joined = join_events(tr, ev, how="right", require="user_id")
    out = joined.groupBy(F.col("isoweek").alias("week")).agg(
        sum_as_bigint("totalEvents").alias("totalEvents"),
        distinct_count("user_id", p.approx_distinct).alias("dimension1"),
    )
    return out


# --------------------------------------------------------------------------- R2
def report_calls_by_campaign(mart: Mart, p: ReportParams) -> DataFrame:
    """R2: weekly phone calls by city (event page), label and campaign type.

    The reference sums at day grain in SQL, then re-groups by week in pandas;
    sums compose, so this is one aggregate at week grain. Sessions are not
    de-duplicated by the reference, so each session row multiplies the event
    sums; both sides are pre-aggregated to the report grain first (sessions to
    (session, week, campaign type) with their row count ``n``), and the sums
    are taken of ``n * value``. The reference stops at a NULL campaign; here
    such sessions have the type ``NO_CAMPAIGN``, so none of their calls is lost.
    Columns: week, city, eventlabel, cpc_type, tot_event, u_event.
    """
    tr = flt.from_date(mart.table("sessions", ["date", "utm_campaign", "session_id"]), "date", p.start_date)
    tr = session_multiplicity(tr, iso_week("date").alias("week"), F.coalesce(campaign_type("utm_campaign"), F.lit(NO_CAMPAIGN)).alias("cpc_type"))
    ev = mart.table("raw_events", ["date", "dateHourMinute", "pagepath", "eventlabel", "uniqueEvents",
                                   "totalEvents", "dimension4"])
    ev = flt.from_date(ev, "dateHourMinute", p.start_date)
    ev = flt.regex_any(ev, "eventlabel", p.call_labels)
    ev = (ev.groupBy("dimension4", city_bucket("pagepath", "0").alias("city"), "eventlabel")
            .agg(F.sum("uniqueEvents").alias("uniqueEvents"), F.sum("totalEvents").alias("totalEvents")))

    joined = join_events(tr, ev, how="left", require="eventlabel")
    tagged = joined.select("week", "city", "eventlabel", "cpc_type",
                           (F.col("n") * F.col("totalEvents")).alias("totalEvents"),
                           (F.col("n") * F.col("uniqueEvents")).alias("uniqueEvents"))
    return second_level(tagged, ["week", "city", "eventlabel", "cpc_type"],
                        {"tot_event": "totalEvents", "u_event": "uniqueEvents"}, ordered=False)


# --------------------------------------------------------------------------- R3
def report_vas_by_action(mart: Mart, p: ReportParams) -> DataFrame:
    """Weekly expanded-phone events by action prefix (text before ``_``).
    Columns: isoweek, eventaction, rashlop."""
    ev = mart.table("raw_events", ["date", "dateHourMinute", "eventlabel", "eventaction", "totalEvents"])
    ev = flt.equals_any(ev, "eventlabel", p.vas_labels)
    ev = flt.from_ts(ev, "dateHourMinute", p.vas_from_ts)
    prefix = regex_prefix("eventaction")
    ev = ev.where(length_positive(prefix))
    return ev.groupBy(*_weeks(p, "dateHourMinute"), prefix.alias("eventaction")).agg(
        sum_as_bigint("totalEvents").alias("rashlop"))


# ----------------------------------------------------------------------- R4-R7
def _section_sessions(mart: Mart, p: ReportParams, cols, section: bool, not_test: bool) -> DataFrame:
    tr = flt.from_date(mart.table("sessions", cols), "date", p.start_date)
    if section:
        tr = flt.url_contains(tr, "landingpage", p.section)
    if not_test:
        tr = flt.url_excludes(tr, "landingpage", p.test_host)
    return tr


def report_mortgage(mart: Mart, p: ReportParams) -> DataFrame:
    """Mortgage clicks by session week and city of the event page, with
    distinct users. Sessions keep their fan-out as a row count ``n`` per
    (session, week, user). Columns: isoweek, city, totalEvents, dimension1."""
    tr = _section_sessions(mart, p, ["date", "landingpage", "session_id", "user_id"], True, True)
    tr = session_multiplicity(tr, *_weeks(p, "date"), "user_id")
    ev = mart.table("raw_events", ["date", "dateHourMinute", "dimension4", "eventlabel", "pagepath", "totalEvents"])
    ev = flt.from_ts(ev, "dateHourMinute", p.lead_from_ts)
    ev = flt.regex_any(ev, "eventlabel", p.mortgage_labels)
    ev = (ev.groupBy("dimension4", city_bucket("pagepath", "REG").alias("city"))
            .agg(F.sum("totalEvents").alias("totalEvents")))
    joined = join_events(tr, ev, how="left", require="dimension4")
    return joined.groupBy(*_week_names(p), "city").agg(
        sum_as_bigint(F.col("n") * F.col("totalEvents")).alias("totalEvents"),
        distinct_count("user_id", p.approx_distinct).alias("dimension1"),
    )


def report_claims(mart: Mart, p: ReportParams) -> DataFrame:
    """Completed claims by session week and city of the *landing* page.
    Both sides are pre-aggregated to the report grain (sessions with their row
    count ``n``). Columns: isoweek, city, totalEvents."""
    tr = _section_sessions(mart, p, ["date", "landingpage", "session_id"], True, False)
    tr = session_multiplicity(tr, *_weeks(p, "date"), city_bucket("landingpage", "REG").alias("city"))
    ev = mart.table("raw_events", ["date", "dateHourMinute", "dimension4", "eventlabel", "totalEvents"])
    ev = flt.from_ts(ev, "dateHourMinute", p.lead_from_ts)
    ev = flt.regex_any(ev, "eventlabel", p.claim_labels)
    ev = ev.groupBy("dimension4").agg(F.sum("totalEvents").alias("totalEvents"))
    joined = join_events(tr, ev, how="left", require="dimension4")
    return joined.groupBy(*_week_names(p), "city").agg(
        sum_as_bigint(F.col("n") * F.col("totalEvents")).alias("totalEvents"))


def _registrations(mart: Mart, p: ReportParams, section: bool) -> DataFrame:
    cols = ["date", "landingpage", "session_id"]
    tr = _section_sessions(mart, p, cols, section, True)
    tr = session_multiplicity(tr, *_weeks(p, "date"))
    ev = mart.table("raw_events", ["date", "dateHourMinute", "dimension4", "eventlabel", "eventcategory",
                                   "pagepath", "totalEvents"])
    ev = flt.from_ts(ev, "dateHourMinute", p.registration_from_ts)
    ev = flt.regex_any(ev, "eventlabel", p.registration_labels)
    ev = flt.regex_any(ev, "eventcategory", p.registration_categories)
    ev = flt.url_excludes(ev, "pagepath", p.registration_page_excluded)
    ev = ev.groupBy("dimension4").agg(F.sum("totalEvents").alias("totalEvents"))
    joined = join_events(tr, ev, how="left", require="dimension4")
    return joined.groupBy(*_week_names(p)).agg(sum_as_bigint(F.col("n") * F.col("totalEvents")).alias("totalEvents"))


def report_registrations(mart: Mart, p: ReportParams) -> DataFrame:
    """Registrations by session week, all non-test traffic.
    Columns: isoweek, totalEvents."""
    return _registrations(mart, p, section=False)


def report_registrations_section(mart: Mart, p: ReportParams) -> DataFrame:
    """R6 restricted to section landing pages."""
    return _registrations(mart, p, section=True)


# ----------------------------------------------------------------------- R8-R10
def _any_match(column: str, patterns) -> "F.Column":
    return reduce(lambda a, b: a | b, [F.col(column).rlike(pat) for pat in patterns])


def label_clicks(mart: Mart, p: ReportParams, labels: dict[str, str]) -> DataFrame:
    """R8 for several labels in one pass, before the weekly sum: each label's
    SUM(users) a (session, week), joined to de-duplicated section sessions on session
    id *and* ISO week. Both sides reach the join as one row per (session, week):
    events summed, sessions as the count ``n`` of their distinct rows, which
    multiplies the sums. One scan and one join serve every label; per label ``alias``
    the output has the product and ``_n_{alias}``, the number of joined events.
    """
    tr = mart.table("sessions", ["date", "landingpage", "session_id", "user_id"])
    tr = flt.from_date(tr, "date", p.start_date)
    tr = flt.url_contains(tr, "landingpage", p.section)
    tr = tr.select(iso_week("date").alias("isoweek"), "landingpage", "session_id", "user_id").distinct()
    # the distinct rows only matter as a multiplicity per (week, session)
    tr = session_multiplicity(tr, "isoweek")
    ev = mart.table("raw_events", ["date", "dateHourMinute", "dimension4", "eventlabel", "users"])
    ev = flt.from_ts(ev, "dateHourMinute", p.deal_from_ts)
    ev = ev.where(_any_match("eventlabel", labels.values()))
    per_label = []
    for alias, label in labels.items():
        hit = F.col("eventlabel").rlike(label)
        per_label += [F.sum(F.when(hit, F.col("users"))).alias(alias),
                      F.count(F.when(hit, F.lit(1))).alias(f"_n_{alias}")]
    ev = ev.groupBy("dimension4", _event_week().alias("isoweek")).agg(*per_label)
    joined = join_events(tr, ev, how="left", require="dimension4", on_week="isoweek")
    n = F.col("n")
    return joined.select("isoweek", *[(n * F.col(c)).alias(c) for alias in labels for c in (alias, f"_n_{alias}")])


def _click_sums(labels) -> list:
    return [c for alias in labels
            for c in (sum_as_bigint(F.col(alias)).alias(alias), F.sum(f"_n_{alias}").alias(f"_n_{alias}"))]


def weekly_label_clicks(mart: Mart, p: ReportParams, labels: dict[str, str]) -> DataFrame:
    """R8 for several labels: ``label_clicks`` summed by week. A week belongs to a
    label's report when its ``_n_{alias}`` is positive."""
    return label_clicks(mart, p, labels).groupBy("isoweek").agg(*_click_sums(labels))


def label_frame(weekly: DataFrame, alias: str) -> DataFrame:
    """One label's report (``isoweek, alias``) out of ``weekly_label_clicks``."""
    return weekly.where(F.col(f"_n_{alias}") > 0).select("isoweek", alias)


def report_deal_clicks(mart: Mart, p: ReportParams) -> DataFrame:
    """R8a. Columns: isoweek, od_clicks."""
    return label_frame(weekly_label_clicks(mart, p, {"od_clicks": p.deal_click_label}), "od_clicks")


def report_guarantee_clicks(mart: Mart, p: ReportParams) -> DataFrame:
    """R8b. Columns: isoweek, gd_clicks."""
    return label_frame(weekly_label_clicks(mart, p, {"gd_clicks": p.guarantee_click_label}), "gd_clicks")


def page_users(mart: Mart, p: ReportParams, pages: dict[str, str]) -> DataFrame:
    """R9 for several pages in one pass, before the weekly count: one row a (week,
    authorised user) with a flag per page ``alias`` viewed in a section session.

    The reference chains page views -> sessions -> users with LEFT joins and
    ``HAVING count > 0``, which equals the inner chain. Only distinct users are
    asked for, so views are cut to distinct (date, session) rows first (one flag
    per page) and sessions map them to (date, user). The authorised user-days
    are put under those rows with a flag of their own, so one (date, user)
    aggregate, partial in each task, both removes repeats and keeps the
    authorised; no join or DISTINCT of the users is needed. Distinct users per week
    are then a (week, user) aggregate and a sum of flags.
    """
    views = mart.table("page_views", ["date", "dateHourMinute", "dimension4", "pagepath"])
    views = flt.from_ts(views, "dateHourMinute", p.deal_from_ts)
    views = views.where(_any_match("pagepath", pages.values()))
    views = views.groupBy(F.col("dateHourMinute").cast("date").alias("date"), "dimension4").agg(
        *[F.max(F.col("pagepath").rlike(page).cast("int")).alias(alias) for alias, page in pages.items()])

    # Sessions are not de-duplicated: the (date, user) aggregate after the join
    # absorbs repeats, and the rows shuffle once, straight to the join keys.
    sess = mart.table("sessions", ["date", "session_id", "user_id", "landingpage"])
    sess = flt.url_contains(sess, "landingpage", p.section)
    sess = flt.from_date(sess, "date", p.start_date)
    sess = sess.select("date", "session_id", "user_id")

    users = mart.table("users_dim", ["date", "dimension1", "dimension2"])
    users = flt.not_equal(users, "dimension2", NOT_AUTHORIZED)
    users = flt.from_date(users, "date", p.start_date)
    users = users.where(F.col("dimension1").isNotNull()).select("date", F.col("dimension1").alias("user_id"))

    flags = list(pages)
    # The ISO week rides along as a third join key. It is a function of the
    # date, so the rows matched are the same, but the views aggregate (already
    # hashed on (date, session)) no longer satisfies the join's distribution:
    # both inputs become plain shuffle stages, which lets AQE split a session
    # id holding a large share of the session rows across tasks.
    views = views.withColumn("_wk", iso_week("date"))
    sess = sess.withColumn("_wk", iso_week("date"))
    cond = ((views["dimension4"] == sess["session_id"]) & (views["date"] == sess["date"])
            & (views["_wk"] == sess["_wk"]))
    viewers = views.join(sess, cond).where(sess["user_id"].isNotNull()).select(sess["date"], sess["user_id"], *flags)
    both = viewers.withColumn("_known", F.lit(None).cast("int")).unionByName(
        users.withColumn("_known", F.lit(1)), allowMissingColumns=True)
    days = both.groupBy("date", "user_id").agg(F.max("_known").alias("_known"), *[F.max(a).alias(a) for a in flags])
    # a user-day without a view has no flag at all
    authorised = days.where((F.col("_known") == 1) & F.col(flags[0]).isNotNull())
    return authorised.groupBy(iso_week("date").alias("isoweek"), "user_id").agg(*[F.max(a).alias(a) for a in flags])


def _user_sums(pages) -> list:
    return [F.sum(alias).cast("bigint").alias(alias) for alias in pages]


def weekly_page_users(mart: Mart, p: ReportParams, pages: dict[str, str]) -> DataFrame:
    """R9 for several pages: weekly distinct authorised users of each (column per page)."""
    return page_users(mart, p, pages).groupBy("isoweek").agg(*_user_sums(pages))


def page_frame(weekly: DataFrame, alias: str) -> DataFrame:
    """One page's report (``isoweek, alias``, HAVING alias > 0) out of ``weekly_page_users``."""
    return flt.having_positive(weekly.select("isoweek", alias), alias)


def report_deal_users(mart: Mart, p: ReportParams) -> DataFrame:
    """R9a. Columns: isoweek, od_us."""
    return page_frame(weekly_page_users(mart, p, {"od_us": p.deal_page}), "od_us")


def report_guarantee_users(mart: Mart, p: ReportParams) -> DataFrame:
    """R9b. Columns: isoweek, gd_us."""
    return page_frame(weekly_page_users(mart, p, {"gd_us": p.guarantee_page}), "gd_us")


def report_deal_combined(mart: Mart, p: ReportParams) -> DataFrame:
    """od_us, gd_us, od_clicks, gd_clicks side by side (position mode by
    default, as the reference). Both pages share one page-view pass and both
    labels one event pass; the two passes share the weekly aggregate, and the
    frames are columns of it. Columns: isoweek, od_us, gd_us, od_clicks, gd_clicks."""
    pages = {"od_us": p.deal_page, "gd_us": p.guarantee_page}
    labels = {"od_clicks": p.deal_click_label, "gd_clicks": p.guarantee_click_label}
    rows = page_users(mart, p, pages).drop("user_id").unionByName(label_clicks(mart, p, labels), allowMissingColumns=True)
    weekly = rows.groupBy("isoweek").agg(*_user_sums(pages), *_click_sums(labels))
    frames = [(n, F.col(n) > 0) for n in pages] + [(n, F.col(f"_n_{n}") > 0) for n in labels]
    return combine_wide(weekly, "isoweek", frames, p.combine_how)


# --------------------------------------------------------------------------- R11
def report_monthly_users(mart: Mart, p: ReportParams) -> DataFrame:
    """Monthly distinct users of section sessions with a medium, one year.
    Columns: month, uniqs."""
    s = flt.in_year(section_sessions(mart, p), "date", p.uniques_year)
    return s.groupBy(month_of("date").alias("month")).agg(distinct_count("user_id", p.approx_distinct).alias("uniqs"))


def section_sessions(mart: Mart, p: ReportParams) -> DataFrame:
    """The sessions that R11 counts, of any year."""
    s = mart.table("sessions", ["date", "user_id", "landingpage", "utm_medium"])
    s = flt.url_contains(s, "landingpage", p.section)
    return flt.not_equal(s, "utm_medium", NO_MEDIUM)


def monthly_users_of(state: DistinctState, p: ReportParams) -> DataFrame:
    """R11 from the state of ``section_sessions``: no session is read."""
    first, after = (F.make_date(F.lit(p.uniques_year + k), F.lit(1), F.lit(1)) for k in (0, 1))
    counted = state.counts([month_of("date")], "uniqs", (F.col("date") >= first) & (F.col("date") < after))
    return counted.select(F.col("_g0").alias("month"), "uniqs")


# --------------------------------------------------------------------------- R12
def report_weekly_cost(mart: Mart, p: ReportParams) -> DataFrame:
    """Weekly positive cost per city with the Monday of the week (in
    ``cost_week_year``). Columns: isoweek, start_week, CITY, COST."""
    if p.cost_week_year is None and not p.with_iso_year:
        raise ValueError("cost_week_year: the year that dates the weeks must be given")
    c = mart.table("costs", ["date", "CITY", "COSTS"])
    c = flt.positive(c, "COSTS")
    c = flt.from_date(c, "date", p.cost_from)
    out = c.groupBy(*_weeks(p, "date"), "CITY").agg(rounded_sum("COSTS").alias("COST"))
    out = out.withColumn("start_week", iso_week_monday(F.col("isoweek"),
                                                       F.col("isoyear") if p.with_iso_year else p.cost_week_year))
    out = move_column(out, "start_week", 1)
    return cast_columns(out, {"isoweek": "bigint", "COST": "double", "CITY": "string", "start_week": "string"})


# --------------------------------------------------------------------------- R13
def report_retention(mart: Mart, p: ReportParams) -> DataFrame:
    """Weekly cohorts (first ISO week, year) x age in weeks 0..52.
    Columns: first_dt, year, New_per_week, week_1 .. week_52."""
    t = mart.table("traffic", ["date", "dimension1", "landingpagepath"])
    t = flt.url_contains(t, "landingpagepath", p.section)
    t = flt.after_date(t, "date", p.retention_after)
    if p.retention_max_age < 52:
        raise ValueError("retention_max_age below 52 would drop cohort ages")
    if p.retention_exact_weeks:  # cohorts by ISO week and ISO year, ages over the years
        return cohort_pivot(exact_members(t), p.retention_max_age)
    return retention_matrix(t, p.retention_week52_year, p.retention_max_age)


# --------------------------------------------------------------------------- R14
def report_banners(mart: Mart, p: ReportParams, view_name: str | None = None) -> DataFrame:
    """Banner events by week, product, action and location.

    Tagging as U7, then the reference's second-stage SQL over a replaced temp
    view (K2), nulls filled with 0 / '0', rows without a week skipped. The view
    name is unique per call (two marts in one session never share it) and the
    view is dropped once the query is analysed.
    Columns: isoweek, product, action_type, card_serp, bnrs, un_users.
    """
    b = mart.table("banners")
    b = flt.from_date(b, "date", p.banners_from)
    spark = b.sparkSession
    view_name = view_name or f"trafficlens_banners_{uuid.uuid4().hex}"
    as_view(purify_banners(b), view_name)
    try:
        grouped = spark.sql(f"""
            SELECT isoweek, product, action_type, card_serp,
                   CAST(SUM(totalevents) AS BIGINT) AS bnrs, CAST(SUM(users) AS BIGINT) AS un_users
            FROM {view_name}
            GROUP BY 1, 2, 3, 4
        """)
    finally:
        spark.catalog.dropTempView(view_name)
    kept = flt.not_null(grouped, "isoweek")
    return fill_null_zero(kept)


# --------------------------------------------------------------------------- R15
def report_vas_by_city(mart: Mart, p: ReportParams) -> DataFrame:
    """Weekly expanded-phone events by city, total and unique.
    Columns: isoweek, city, tot, un."""
    ev = mart.table("raw_events", ["date", "dateHourMinute", "eventlabel", "pagepath", "totalEvents", "uniqueEvents"])
    ev = flt.from_date(ev, "dateHourMinute", p.vas_city_from)
    ev = flt.regex_any(ev, "eventlabel", p.vas_city_labels)
    return ev.groupBy(*_weeks(p, F.col("dateHourMinute").cast("date")),
                      city_bucket("pagepath", "REG").alias("city")).agg(
        sum_as_bigint("totalEvents").alias("tot"), sum_as_bigint("uniqueEvents").alias("un"))


def report_events(mart: Mart, p: ReportParams) -> DataFrame:
    """The events any report reads: a label any report asks for, from the
    earliest bound any report uses. Every report's own event filter selects a
    subset of these rows, so the reports give the same results over this
    table as over the whole ``raw_events`` -- the publish run scans the event
    table once instead of once per report."""
    ts_bounds = [p.vas_from_ts, p.lead_from_ts, p.registration_from_ts, p.deal_from_ts]
    date_bounds = [p.start_date, p.vas_city_from]
    earliest = min([flt.normalize_ts(b) for b in ts_bounds] + [flt.normalize_ts(d[:10]) for d in date_bounds])
    patterns = [p.phone_click_labels, p.call_labels, p.mortgage_labels, p.claim_labels, p.registration_labels,
                p.deal_click_label, p.guarantee_click_label, p.vas_city_labels]
    ev = flt.from_ts(mart.table("raw_events"), "dateHourMinute", earliest)
    return ev.where(_any_match("eventlabel", patterns) | F.col("eventlabel").isin(list(p.vas_labels)))


# The reference's row order per report (ORDER BY / pandas group order).
# report_deal_combined is ordered by position inside the plan itself.
REPORT_ORDER: dict[str, tuple[str, ...]] = {
    "report_phone_clicks": ("week",),
    "report_calls_by_campaign": ("week", "city", "eventlabel", "cpc_type"),
    "report_vas_by_action": ("isoweek", "eventaction"),
    "report_mortgage": ("isoweek", "city"),
    "report_claims": ("isoweek", "city"),
    "report_registrations": ("isoweek",),
    "report_registrations_section": ("isoweek",),
    "report_deal_clicks": ("isoweek",),
    "report_guarantee_clicks": ("isoweek",),
    "report_deal_users": ("isoweek",),
    "report_guarantee_users": ("isoweek",),
    "report_deal_combined": (),
    "report_monthly_users": ("month",),
    "report_weekly_cost": ("isoweek", "CITY"),
    "report_retention": ("year", "first_dt"),
    "report_banners": ("isoweek",),
    "report_vas_by_city": ("isoweek", "city"),
}


def ordered(name: str, df: DataFrame) -> DataFrame:
    """The report in the reference's row order (a distributed sort)."""
    keys = REPORT_ORDER[name]
    return sort_by(df, *keys) if keys else df


# Report registry: key -> report function.
REPORTS = {
    "report_phone_clicks": report_phone_clicks,
    "report_calls_by_campaign": report_calls_by_campaign,
    "report_vas_by_action": report_vas_by_action,
    "report_mortgage": report_mortgage,
    "report_claims": report_claims,
    "report_registrations": report_registrations,
    "report_registrations_section": report_registrations_section,
    "report_deal_clicks": report_deal_clicks,
    "report_guarantee_clicks": report_guarantee_clicks,
    "report_deal_users": report_deal_users,
    "report_guarantee_users": report_guarantee_users,
    "report_deal_combined": report_deal_combined,
    "report_monthly_users": report_monthly_users,
    "report_weekly_cost": report_weekly_cost,
    "report_retention": report_retention,
    "report_banners": report_banners,
    "report_vas_by_city": report_vas_by_city,
}
