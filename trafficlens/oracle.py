"""DuckDB oracle: for each catalog key, independent SQL over the same tables.

Every text starts with the fixture CTEs (the same SQL the Spark side runs to
derive the mart tables) and then states the key's semantics as one plain
query -- row-level joins, no pre-aggregation, the retention self-join, one
filtered count per cohort age -- so it checks the Spark plans' rewrites
(multiplicities, semi-joins, single-pass cohorts, stacked frames) rather than
repeating them.
"""

from __future__ import annotations

import re

from trafficlens.params import TESTDATA_LOADED_UNTIL, ReportParams
from trafficlens.sources.fixtures import FIXTURE_SQL, duckdb_ctes

P = ReportParams.for_testdata()


# ------------------------------------------------------------------ SQL snippets
def wk(x: str) -> str:
    return f"CAST(EXTRACT(week FROM {x}) AS BIGINT)"


def city(x: str, default: str) -> str:
    return (f"(CASE WHEN {x} LIKE '%mosk%' THEN 'MSK' "
            f"WHEN {x} LIKE '%sankt-%' OR {x} LIKE '%lening%' THEN 'SPB' ELSE '{default}' END)")


def campaign(x: str) -> str:
    return (f"(CASE WHEN strpos({x}, 'second') > 0 THEN 'УП реклама' "
            f"WHEN strpos({x}, 'new-building') > 0 THEN 'Новосторойки реклама' "
            f"WHEN {x} = '(not set)' THEN 'Не рекламные' "
            f"WHEN {x} IS NOT NULL THEN 'Другие рекламные кампании' END)")


def location(x: str) -> str:
    return f"(CASE WHEN contains(lower({x}), 'serp') THEN 'SERP' WHEN contains(lower({x}), 'card') THEN 'CARD' END)"


def product(x: str) -> str:
    return (f"(CASE WHEN contains(lower({x}), 'protection') OR contains(lower({x}), 'guarantee') THEN 'protection' "
            f"WHEN contains(lower({x}), 'onlinebuy') THEN 'onlinebuy' END)")


def action(x: str) -> str:
    return f"(CASE WHEN contains(lower({x}), 'click') THEN 'click' WHEN contains(lower({x}), 'view') THEN 'view' END)"


def geo(x: str) -> str:
    msk = " OR ".join(f"contains({x}, '{g}')" for g in ("moskva-i-oblast", "moskva", "moskovskaya-oblast"))
    spb = " OR ".join(f"contains({x}, '{g}')"
                      for g in ("sankt-peterburg", "leningradskaya-oblast", "sankt-peterburg-i-oblast"))
    return f"(CASE WHEN {msk} THEN 'MSK' WHEN {spb} THEN 'SPB' END)"


PREFIX_RE = "(.*?)_.*?"


def prefix(x: str) -> str:
    return f"(CASE WHEN regexp_matches({x}, '{PREFIX_RE}') THEN regexp_extract({x}, '{PREFIX_RE}', 1) END)"


def monday(year: str, week: str) -> str:
    jan4 = f"make_date(CAST({year} AS INTEGER), 1, 4)"
    return f"({jan4} - CAST(isodow({jan4}) - 1 AS INTEGER) + CAST(({week} - 1) * 7 AS INTEGER))"


def d(value: str) -> str:
    return f"DATE '{value[:10]}'"


def ts(value: str) -> str:
    return f"TIMESTAMP '{value}'"


def s_(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_FIXTURE_NAMES = tuple(n for n in FIXTURE_SQL if n not in ("ev0", "s0"))


def with_fixtures(body: str) -> str:
    """Prefix ``body`` with the CTEs of every fixture table it names."""
    names = [n for n in _FIXTURE_NAMES if re.search(rf"\b{n}\b", body)]
    return f"{duckdb_ctes(names)}\nSELECT * FROM (\n{body}\n) AS q"


# ------------------------------------------------------------------ reports
# Each report is stated as one plain query: inner joins with every condition in
# WHERE. (A LEFT join followed by a NOT NULL test on the optional side, or by
# HAVING count > 0, keeps exactly the inner-join rows.)

def r1() -> str:
    return f"""
SELECT {wk('CAST(e.dateHourMinute AS DATE)')} AS week,
       CAST(SUM(e.totalEvents) AS BIGINT) AS totalEvents,
       COUNT(DISTINCT s.user_id) AS dimension1
FROM raw_events e
JOIN (SELECT DISTINCT session_id, user_id FROM sessions
      WHERE date >= {d(P.start_date)} AND landingpage LIKE '%{P.section}%' AND utm_source <> '(direct)') s
  ON s.session_id = e.dimension4
WHERE s.user_id IS NOT NULL
  AND regexp_matches(e.eventlabel, {s_(P.phone_click_labels)})
  AND e.dateHourMinute >= {ts(P.start_date[:10] + ' 00:00:00')}
  AND e.eventlabel NOT LIKE '%{P.phone_click_excluded}%'
GROUP BY 1"""


def r2() -> str:
    return f"""
SELECT {wk('s.date')} AS week, {city('e.pagepath', '0')} AS city, e.eventlabel AS eventlabel,
       coalesce({campaign('s.utm_campaign')}, '(no campaign)') AS cpc_type,
       CAST(SUM(e.totalEvents) AS BIGINT) AS tot_event, CAST(SUM(e.uniqueEvents) AS BIGINT) AS u_event
FROM sessions s JOIN raw_events e ON e.dimension4 = s.session_id
WHERE s.date >= {d(P.start_date)}
  AND e.dateHourMinute >= {ts(P.start_date[:10] + ' 00:00:00')}
  AND regexp_matches(e.eventlabel, {s_(P.call_labels)})
GROUP BY 1, 2, 3, 4"""


def r3() -> str:
    labels = ", ".join(s_(x) for x in P.vas_labels)
    return f"""
SELECT {wk('dateHourMinute')} AS isoweek, {prefix('eventaction')} AS eventaction,
       CAST(SUM(totalEvents) AS BIGINT) AS rashlop
FROM raw_events
WHERE eventlabel IN ({labels}) AND dateHourMinute >= {ts(P.vas_from_ts)}
  AND length({prefix('eventaction')}) > 0
GROUP BY 1, 2"""


def r4() -> str:
    return f"""
SELECT {wk('s.date')} AS isoweek, {city('e.pagepath', 'REG')} AS city,
       CAST(SUM(e.totalEvents) AS BIGINT) AS totalEvents, COUNT(DISTINCT s.user_id) AS dimension1
FROM sessions s JOIN raw_events e ON e.dimension4 = s.session_id
WHERE s.date >= {d(P.start_date)} AND s.landingpage LIKE '%{P.section}%'
  AND s.landingpage NOT LIKE '%{P.test_host}%'
  AND e.dateHourMinute >= {ts(P.lead_from_ts)} AND regexp_matches(e.eventlabel, {s_(P.mortgage_labels)})
GROUP BY 1, 2"""


def r5() -> str:
    return f"""
SELECT {wk('s.date')} AS isoweek, {city('s.landingpage', 'REG')} AS city,
       CAST(SUM(e.totalEvents) AS BIGINT) AS totalEvents
FROM sessions s JOIN raw_events e ON e.dimension4 = s.session_id
WHERE s.date >= {d(P.start_date)} AND s.landingpage LIKE '%{P.section}%'
  AND e.dateHourMinute >= {ts(P.lead_from_ts)} AND regexp_matches(e.eventlabel, {s_(P.claim_labels)})
GROUP BY 1, 2"""


def r6(section: bool) -> str:
    extra = f"\n  AND s.landingpage LIKE '%{P.section}%'" if section else ""
    return f"""
SELECT {wk('s.date')} AS isoweek, CAST(SUM(e.totalEvents) AS BIGINT) AS totalEvents
FROM sessions s JOIN raw_events e ON e.dimension4 = s.session_id
WHERE s.date >= {d(P.start_date)} AND s.landingpage NOT LIKE '%{P.test_host}%'{extra}
  AND e.dateHourMinute >= {ts(P.registration_from_ts)}
  AND regexp_matches(e.eventlabel, {s_(P.registration_labels)})
  AND regexp_matches(e.eventcategory, {s_(P.registration_categories)})
  AND e.pagepath NOT LIKE '%{P.registration_page_excluded}%'
GROUP BY 1"""


def r8(label: str, alias: str) -> str:
    """Sessions count once per distinct (week, landing page, session, user)."""
    return f"""
SELECT {wk('CAST(e.dateHourMinute AS DATE)')} AS isoweek, CAST(SUM(e.users) AS BIGINT) AS {alias}
FROM raw_events e
JOIN (SELECT DISTINCT {wk('date')} AS wk, landingpage, session_id, user_id FROM sessions
      WHERE date >= {d(P.start_date)} AND landingpage LIKE '%{P.section}%') s
  ON s.session_id = e.dimension4 AND s.wk = {wk('CAST(e.dateHourMinute AS DATE)')}
WHERE e.dateHourMinute >= {ts(P.deal_from_ts)} AND regexp_matches(e.eventlabel, {s_(label)})
GROUP BY 1"""


def r9(page: str, alias: str) -> str:
    return f"""
SELECT {wk('u.date')} AS isoweek, COUNT(DISTINCT u.dimension1) AS {alias}
FROM page_views v
JOIN sessions s ON s.session_id = v.dimension4 AND s.date = CAST(v.dateHourMinute AS DATE)
JOIN users_dim u ON u.dimension1 = s.user_id AND u.date = s.date
WHERE regexp_matches(v.pagepath, {s_(page)}) AND v.dateHourMinute >= {ts(P.deal_from_ts)}
  AND s.landingpage LIKE '%{P.section}%' AND s.date >= {d(P.start_date)}
  AND u.dimension2 <> 'not_authorized' AND u.date >= {d(P.start_date)}
GROUP BY 1"""


def _af2_parts() -> list[tuple[str, str]]:
    return [(r9(P.deal_page, "od_us"), "od_us"), (r9(P.guarantee_page, "gd_us"), "gd_us"),
            (r8(P.deal_click_label, "od_clicks"), "od_clicks"),
            (r8(P.guarantee_click_label, "gd_clicks"), "gd_clicks")]


def r10_position() -> str:
    parts = _af2_parts()
    ctes = ",\n".join(
        f"n{i} AS (SELECT isoweek, {alias}, ROW_NUMBER() OVER (ORDER BY isoweek ASC NULLS FIRST) AS pos "
        f"FROM ({body}) AS f{i})"
        for i, (body, alias) in enumerate(parts))
    joins, seen = "n0", ["n0.pos"]
    for i in range(1, len(parts)):
        joins += f" FULL JOIN n{i} ON COALESCE({', '.join(seen)}) = n{i}.pos"
        seen.append(f"n{i}.pos")
    values = ", ".join(f"n{i}.{alias}" for i, (_, alias) in enumerate(parts))
    return f"WITH {ctes}\nSELECT n0.isoweek AS isoweek, {values} FROM {joins}"


def r10_key() -> str:
    parts = _af2_parts()
    ctes = ",\n".join(f"k{i} AS ({body})" for i, (body, _) in enumerate(parts))
    joins, seen = "k0", ["k0.isoweek"]
    for i in range(1, len(parts)):
        joins += f" FULL JOIN k{i} ON COALESCE({', '.join(seen)}) = k{i}.isoweek"
        seen.append(f"k{i}.isoweek")
    values = ", ".join(f"k{i}.{alias}" for i, (_, alias) in enumerate(parts))
    return f"WITH {ctes}\nSELECT COALESCE({', '.join(seen)}) AS isoweek, {values} FROM {joins}"


def r11() -> str:
    return f"""
SELECT CAST(month(date) AS BIGINT) AS month, COUNT(DISTINCT user_id) AS uniqs
FROM sessions
WHERE landingpage LIKE '%{P.section}%' AND utm_medium <> '(none)' AND year(date) = {P.uniques_year}
GROUP BY 1"""


def r12() -> str:
    return f"""
SELECT weekly.isoweek AS isoweek, CAST({monday(str(P.cost_week_year), 'weekly.isoweek')} AS VARCHAR) AS start_week,
       weekly.CITY AS CITY, weekly.COST AS COST
FROM (SELECT {wk('date')} AS isoweek, CITY,
             CAST(ROUND(SUM(CAST(COSTS AS DECIMAL(28, 10))), 2) AS DOUBLE) AS COST
      FROM costs WHERE COSTS > 0 AND date >= {d(P.cost_from)} GROUP BY 1, 2) AS weekly"""


def retention_sql(where: str, week52_year: int, max_age: int = 52) -> str:
    """Cohort = a user's first active date; age = active ISO week minus the
    first one, wrapping at 52; one column per age counts (user, week) pairs."""
    counts = ",\n  ".join(
        f"COUNT(*) FILTER (WHERE age = {a}) AS {'New_per_week' if a == 0 else f'week_{a}'}"
        for a in range(max_age + 1))
    return f"""
WITH firsts AS (
  SELECT dimension1, MIN(date) AS first_date FROM traffic {where} GROUP BY dimension1),
active AS (
  SELECT DISTINCT dimension1, {wk('date')} AS wk FROM traffic {where}),
aged AS (
  SELECT {wk('f.first_date')} AS first_dt,
         CAST(CASE WHEN {wk('f.first_date')} = 52 THEN {week52_year} ELSE year(f.first_date) END AS BIGINT) AS year,
         CASE WHEN a.wk < {wk('f.first_date')} THEN 52 - {wk('f.first_date')} + a.wk
              ELSE a.wk - {wk('f.first_date')} END AS age
  FROM active a JOIN firsts f ON f.dimension1 = a.dimension1)
SELECT first_dt, year,
  {counts}
FROM aged GROUP BY first_dt, year"""


def r13() -> str:
    return retention_sql(f"WHERE landingpagepath LIKE '%{P.section}%' AND date > {d(P.retention_after)}",
                         P.retention_week52_year)


def r14() -> str:
    return f"""
WITH tagged AS (
  SELECT isoweek, CAST(totalevents AS BIGINT) AS totalevents, users,
         {product('eventlabel')} AS product, {location('eventlabel')} AS card_serp,
         {action('eventlabel')} AS action_type
  FROM banners WHERE date >= {s_(P.banners_from)})
SELECT isoweek, product, COALESCE(action_type, '0') AS action_type, COALESCE(card_serp, '0') AS card_serp,
       COALESCE(CAST(SUM(totalevents) AS BIGINT), 0) AS bnrs, COALESCE(CAST(SUM(users) AS BIGINT), 0) AS un_users
FROM tagged
WHERE product IS NOT NULL AND isoweek IS NOT NULL
GROUP BY isoweek, product, action_type, card_serp"""


def r15() -> str:
    return f"""
SELECT {wk('CAST(dateHourMinute AS DATE)')} AS isoweek, {city('pagepath', 'REG')} AS city,
       CAST(SUM(totalEvents) AS BIGINT) AS tot, CAST(SUM(uniqueEvents) AS BIGINT) AS un
FROM raw_events
WHERE dateHourMinute >= {ts(P.vas_city_from[:10] + ' 00:00:00')} AND regexp_matches(eventlabel, {s_(P.vas_city_labels)})
GROUP BY 1, 2"""


# ------------------------------------------------------------------ report-API rows
def api_rows(date_expr: str, users_expr: str) -> str:
    """The banner request's rows: the hits that pass its filter."""
    return f"""
SELECT isoweek, {date_expr} AS date, eventlabel AS "eventLabel", eventcategory AS "eventCategory",
       eventaction AS "eventAction", totalevents, {users_expr} AS users
FROM banner_hits
WHERE regexp_matches(pagepath, '(?i)/nedvizhimost') AND regexp_matches(eventlabel, '(?i)banner')"""


FLAT_SQL = api_rows("strftime(CAST(date AS DATE), '%Y%m%d')", "CAST(users AS VARCHAR)")
TARGET_SQL = api_rows("date", "CAST(users AS BIGINT)")


def windows_sql(step: int) -> str:
    return f"""
WITH bnd AS (SELECT MIN(CAST(date AS DATE)) AS s, MAX(CAST(date AS DATE)) AS e FROM banners),
k AS (SELECT s, e, CASE WHEN e - s < 0 THEN 0 WHEN e - s = 0 THEN 1
                        ELSE CAST(ceil((e - s) / {step}.0) AS BIGINT) END AS k FROM bnd),
i AS (SELECT s, e, k, unnest(range(k)) AS i FROM k)
SELECT CASE WHEN i = k - 1 THEN s ELSE e - CAST(i * {step} + {step - 1} AS INTEGER) END AS window_start,
       e - CAST(i * {step} AS INTEGER) AS window_end
FROM i"""


# ------------------------------------------------------------------ all keys
def _bodies() -> dict[str, str]:
    tag_cols = {"tag_location": (location, "card_serp"), "tag_product": (product, "product"),
                "tag_action": (action, "action_type")}
    phone = s_(P.phone_click_labels)
    day_grain = f"""
SELECT s.date AS date, {city('e.pagepath', '0')} AS city, e.pagepath AS pagepath, e.eventlabel AS eventlabel,
       s.utm_campaign AS utm_campaign,
       CAST(SUM(e.uniqueEvents) AS BIGINT) AS uniqueEvents, CAST(SUM(e.totalEvents) AS BIGINT) AS totalEvents
FROM sessions s JOIN raw_events e ON e.dimension4 = s.session_id
WHERE s.date >= {d(P.start_date)} AND e.dateHourMinute >= {ts(P.start_date[:10] + ' 00:00:00')}
  AND regexp_matches(e.eventlabel, {s_(P.call_labels)})
GROUP BY 1, 2, 3, 4, 5"""
    traffic_section = f"WHERE landingpagepath LIKE '%{P.section}%'"
    first_week = f"""
SELECT {wk('MIN(date)')} AS first_dt,
       CAST(CASE WHEN {wk('MIN(date)')} = 52 THEN {P.retention_week52_year}
                 ELSE EXTRACT(year FROM MIN(date)) END AS BIGINT) AS year, dimension1
FROM traffic {{where}} GROUP BY dimension1"""
    b = {
        # reports
        "report_phone_clicks": r1(),
        "report_calls_by_campaign": r2(),
        "report_vas_by_action": r3(),
        "report_mortgage": r4(),
        "report_claims": r5(),
        "report_registrations": r6(False),
        "report_registrations_section": r6(True),
        "report_deal_clicks": r8(P.deal_click_label, "od_clicks"),
        "report_guarantee_clicks": r8(P.guarantee_click_label, "gd_clicks"),
        "report_deal_users": r9(P.deal_page, "od_us"),
        "report_guarantee_users": r9(P.guarantee_page, "gd_us"),
        "report_deal_combined": r10_position(),
        "combine_by_position": r10_position(),
        "combine_by_week": r10_key(),
        "report_monthly_users": r11(),
        "report_weekly_cost": r12(),
        "report_retention": r13(),
        "report_banners": r14(),
        "report_vas_by_city": r15(),
        # sources
        "scan_sessions": "SELECT * FROM sessions",
        "scan_raw_events": "SELECT * FROM raw_events",
        "scan_page_views": "SELECT * FROM page_views",
        "scan_users": "SELECT * FROM users_dim",
        "scan_traffic": "SELECT * FROM traffic",
        "scan_costs": "SELECT * FROM costs",
        "scan_banners": f"SELECT * FROM banners WHERE date >= {s_(P.banners_from)}",
        "flatten_report": FLAT_SQL,
        "flatten_report_empty": FLAT_SQL + " AND day(CAST(date AS DATE)) % 2 = 0",
        "report_union_windows": FLAT_SQL,
        "source_filter": "SELECT * FROM raw_events WHERE regexp_matches(pagepath, '(?i)/nedvizhimost') "
                         "AND regexp_matches(eventlabel, '(?i)click')",
        # sinks
        "append_banners": TARGET_SQL,
        "replace_temp_view": "SELECT isoweek, eventlabel, users FROM banners WHERE users > 1",
        "report_matrix": r15(),
        # projections
        "cast_date": "SELECT dimension4, dateHourMinute, CAST(dateHourMinute AS DATE) AS event_date FROM raw_events",
        "cast_datetime": "SELECT session_id, date, CAST(date AS TIMESTAMP) AS session_dt FROM sessions",
        "iso_week": f"SELECT date, dimension1, {wk('date')} AS isoweek FROM traffic",
        "iso_week_pd": f"SELECT CAST(date AS VARCHAR) AS date, CITY, {wk('date')} AS week FROM costs",
        "month_of": "SELECT session_id, date, CAST(EXTRACT(month FROM date) AS BIGINT) AS month FROM sessions",
        "year_of": "SELECT date, dimension1, CAST(EXTRACT(year FROM date) AS BIGINT) AS year FROM traffic",
        "iso_week_monday": f"SELECT date, CITY, {wk('date')} AS isoweek, "
                           f"{monday('isoyear(date)', wk('date'))} AS start_week FROM costs",
        "city_bucket": f"SELECT dimension4, pagepath, {city('pagepath', 'REG')} AS city, "
                       f"{city('pagepath', '0')} AS city0 FROM raw_events",
        "cohort_year": f"SELECT date, dimension1, CASE WHEN {wk('date')} = 52 THEN "
                       f"CAST({P.retention_week52_year} AS BIGINT) ELSE CAST(EXTRACT(year FROM date) AS BIGINT) "
                       f"END AS year FROM traffic",
        "cohort_age": f"SELECT date, dimension1, CAST(CASE WHEN {wk('date')} < {wk('date - 90')} "
                      f"THEN (52 - {wk('date - 90')}) + {wk('date')} ELSE {wk('date')} - {wk('date - 90')} "
                      f"END AS BIGINT) AS senior FROM traffic",
        "regex_prefix": f"SELECT dimension4, eventaction, {prefix('eventaction')} AS prefix FROM raw_events",
        "length_positive": f"SELECT dimension4, eventaction, {prefix('eventaction')} AS prefix FROM raw_events "
                           f"WHERE length({prefix('eventaction')}) > 0",
        "round2": "SELECT date, CITY, CAST(ROUND(CAST(COSTS AS DECIMAL(18, 4)) * 0.5, 2) AS DOUBLE) AS half_cost "
                  "FROM costs",
        "lower_contains": "SELECT date, eventlabel, contains(lower(eventlabel), 'serp') AS has_serp FROM banners",
        "normalize_columns": "SELECT date, dateHourMinute AS datehourminute, dimension4, eventlabel, eventcategory, "
                             "eventaction, pagepath, totalEvents AS totalevents, uniqueEvents AS uniqueevents, "
                             "users FROM raw_events",
        "parse_compact_date": "SELECT replace(date, '-', '') AS compact, eventlabel, "
                              "CAST(strptime(replace(date, '-', ''), '%Y%m%d') AS DATE) AS parsed FROM banners",
        "cast_metrics": "SELECT date, eventlabel, CAST(totalevents AS BIGINT) AS totalevents, "
                        "CAST(users AS BIGINT) AS users FROM banners",
        "cast_float_string": "SELECT CAST(date AS VARCHAR) AS date, CITY, CAST(COSTS AS DOUBLE) AS COSTS FROM costs",
        "parse_iso_date": "SELECT eventlabel, CAST(date AS DATE) AS parsed FROM banners",
        "reorder_columns": "SELECT date, COSTS, CITY FROM costs",
        "drop_columns": "SELECT isoweek, date, eventlabel, totalevents, users FROM banners",
        "fill_null_zero": "SELECT dateHourMinute, COALESCE(dimension4, '0') AS dimension4, "
                          "COALESCE(eventlabel, '0') AS eventlabel, COALESCE(totalEvents, 0) AS totalEvents "
                          "FROM raw_events",
        # filters
        "filter_date_from": f"SELECT * FROM sessions WHERE date >= {d(P.start_date)}",
        "filter_ts_from": f"SELECT * FROM raw_events WHERE dateHourMinute >= {ts(P.lead_from_ts)}",
        "filter_date_after": f"SELECT * FROM traffic WHERE date > {d(P.retention_after)}",
        "filter_like": f"SELECT * FROM sessions WHERE landingpage LIKE '%{P.section}%'",
        "filter_not_like": f"SELECT * FROM sessions WHERE landingpage NOT LIKE '%{P.test_host}%'",
        "filter_not_equal": "SELECT * FROM users_dim WHERE dimension2 <> 'not_authorized'",
        "filter_regex_any": f"SELECT * FROM raw_events WHERE regexp_matches(eventlabel, {phone})",
        "filter_regex_anchored": f"SELECT * FROM raw_events WHERE regexp_matches(eventlabel, {s_(P.mortgage_labels)})",
        "filter_equal_or": "SELECT * FROM raw_events WHERE "
                           + " OR ".join(f"eventlabel = {s_(x)}" for x in P.vas_labels),
        "filter_post_join_not_null": "SELECT session_id, user_id, eventlabel, totalEvents FROM sessions "
                                     "LEFT JOIN raw_events ON session_id = dimension4 WHERE eventlabel IS NOT NULL",
        "filter_positive": "SELECT * FROM costs WHERE COSTS > 0",
        "filter_year": f"SELECT * FROM traffic WHERE EXTRACT(year FROM date) = {P.cost_week_year}",
        "having_positive": "SELECT dimension4, COUNT(DISTINCT eventlabel) AS labels FROM raw_events "
                           "GROUP BY dimension4 HAVING COUNT(DISTINCT eventlabel) > 0",
        "filter_tagged": f"SELECT *, {product('eventlabel')} AS product FROM banners "
                         f"WHERE {product('eventlabel')} IS NOT NULL",
        "filter_null_week": "SELECT * FROM banners WHERE isoweek IS NOT NULL",
        # joins
        "join_right_sessions_events": "SELECT session_id, user_id, eventlabel, totalEvents "
                                      "FROM (SELECT DISTINCT session_id, user_id FROM sessions) s "
                                      "RIGHT JOIN raw_events e ON s.session_id = e.dimension4 "
                                      "WHERE user_id IS NOT NULL",
        "join_left_sessions_events": "SELECT sessions.date AS date, session_id, utm_campaign, eventlabel, totalEvents FROM sessions "
                                     "LEFT JOIN raw_events ON session_id = dimension4 WHERE eventlabel IS NOT NULL",
        "join_session_week": f"""
SELECT e.isoweek AS isoweek, session_id, user_id, eventlabel, users
FROM (SELECT DISTINCT {wk('date')} AS isoweek, session_id, user_id FROM sessions) s
LEFT JOIN (SELECT {wk('CAST(dateHourMinute AS DATE)')} AS isoweek, dimension4, eventlabel, users
           FROM raw_events) e
  ON s.session_id = e.dimension4 AND s.isoweek = e.isoweek
WHERE eventlabel IS NOT NULL""",
        "join_three_way_left": """
SELECT v.date AS date, v.dimension4 AS dimension4, s.user_id AS user_id, u.dimension2 AS dimension2
FROM (SELECT CAST(dateHourMinute AS DATE) AS date, dimension4 FROM page_views GROUP BY 1, 2) v
LEFT JOIN (SELECT date, session_id, user_id FROM sessions GROUP BY 1, 2, 3) s
  ON v.dimension4 = s.session_id AND v.date = s.date
LEFT JOIN (SELECT date, dimension1, dimension2 FROM users_dim GROUP BY 1, 2, 3) u
  ON s.user_id = u.dimension1 AND s.date = u.date""",
        "join_cohort_activity": f"""
WITH a AS (SELECT {wk('date')} AS iso_week, dimension1 FROM traffic
           {traffic_section} AND date > {d(P.retention_after)} GROUP BY 1, 2),
b AS ({first_week.format(where=traffic_section + ' AND date > ' + d(P.retention_after))})
SELECT a.dimension1 AS dimension1, iso_week, first_dt, year FROM a, b WHERE a.dimension1 = b.dimension1""",
        # aggregates
        "agg_sum": "SELECT eventlabel, CAST(SUM(totalEvents) AS BIGINT) AS tot, CAST(SUM(users) AS BIGINT) AS users "
                   "FROM raw_events GROUP BY eventlabel",
        "agg_count_distinct": "SELECT date, COUNT(DISTINCT user_id) AS uniqs FROM sessions GROUP BY date",
        "agg_sum_and_distinct": f"SELECT {wk('dateHourMinute')} AS isoweek, CAST(SUM(totalEvents) AS BIGINT) "
                                f"AS totalEvents, COUNT(DISTINCT dimension4) AS sessions FROM raw_events GROUP BY 1",
        "agg_first_week": first_week.format(where=traffic_section),
        "agg_max_date": "SELECT MAX(date) AS max_date FROM sessions",
        "agg_cohort_pivot": retention_sql("", P.retention_week52_year),
        "agg_dedupe": "SELECT CAST(dateHourMinute AS DATE) AS date, dimension4 FROM page_views GROUP BY 1, 2",
        "agg_group_by_expr": f"SELECT {city('pagepath', 'REG')} AS city, {prefix('eventaction')} AS prefix, "
                             f"CAST(SUM(totalEvents) AS BIGINT) AS tot FROM raw_events GROUP BY 1, 2",
        "agg_second_level": "SELECT eventlabel, eventcategory, CAST(SUM(totalEvents) AS BIGINT) AS tot_event, "
                            "CAST(SUM(uniqueEvents) AS BIGINT) AS u_event FROM raw_events "
                            "WHERE eventlabel IS NOT NULL AND eventcategory IS NOT NULL GROUP BY 1, 2 ORDER BY 1, 2",
        "agg_four_keys": f"""
SELECT isoweek, product, action_type, card_serp, CAST(SUM(totalevents) AS BIGINT) AS bnrs,
       CAST(SUM(users) AS BIGINT) AS un_users
FROM (SELECT isoweek, CAST(totalevents AS BIGINT) AS totalevents, users, {product('eventlabel')} AS product,
             {action('eventlabel')} AS action_type, {location('eventlabel')} AS card_serp FROM banners) t
WHERE product IS NOT NULL GROUP BY 1, 2, 3, 4""",
        "agg_rounded_sum": "SELECT CITY, CAST(ROUND(SUM(CAST(COSTS AS DECIMAL(28, 10))), 2) AS DOUBLE) AS COST "
                           "FROM costs GROUP BY CITY",
        # sorts
        "sort_one_key": "SELECT * FROM costs ORDER BY date NULLS FIRST",
        "sort_multi_key": "SELECT * FROM costs ORDER BY CITY NULLS FIRST, date NULLS FIRST",
        # tagging
        "tag_campaign": f"SELECT session_id, utm_campaign, {campaign('utm_campaign')} AS cpc_type FROM sessions",
        **{k: f"SELECT date, eventlabel, {fn('eventlabel')} AS {alias} FROM banners"
           for k, (fn, alias) in tag_cols.items()},
        "tag_geo": f"SELECT session_id, landingpage, {geo('landingpage')} AS geo FROM sessions",
        "purify_calls": f"SELECT date, city, pagepath, eventlabel, utm_campaign, uniqueEvents, totalEvents, "
                        f"{campaign('utm_campaign')} AS cpc_type, {wk('date')} AS week FROM ({day_grain}) dg",
        "purify_banners": f"SELECT isoweek, date, eventlabel, CAST(totalevents AS BIGINT) AS totalevents, "
                          f"CAST(users AS BIGINT) AS users, {product('eventlabel')} AS product, "
                          f"{location('eventlabel')} AS card_serp, {action('eventlabel')} AS action_type "
                          f"FROM banners WHERE {product('eventlabel')} IS NOT NULL",
        # incremental
        "high_water_mark": f"SELECT MAX(CAST(date AS DATE)) AS max_date, "
                           f"COALESCE(MAX(CAST(date AS DATE)) + 1, {d(P.load_default_start)}) AS start_date, "
                           f"{d(P.load_today)} - 1 AS end_date FROM banners",
        "date_windows": windows_sql(P.window_step_days),
        "incremental_append": TARGET_SQL,
        "window_ledger": ledger_windows_sql(P.window_step_days),
    }
    b["cohort_state"] = b["report_retention"]
    b["report_retention_exact"] = exact_retention_sql(156)
    b["distinct_state"] = b["report_monthly_users"]
    return b


def exact_retention_sql(max_age: int) -> str:
    """Self-join of the traffic with each user's first date; ages in whole ISO weeks."""
    ages = [f"COUNT(*) FILTER (WHERE age = {a}) AS {'New_per_week' if a == 0 else f'week_{a}'}" for a in range(max_age + 1)]
    return f"""
SELECT * FROM (
WITH t AS (SELECT dimension1, date FROM traffic WHERE landingpagepath LIKE '%{P.section}%' AND date > {d(P.retention_after)}),
f AS (SELECT dimension1, MIN(date) AS first_date FROM t GROUP BY 1),
a AS (SELECT DISTINCT t.dimension1, first_date,
             (CAST(date_trunc('week', date) AS DATE) - CAST(date_trunc('week', first_date) AS DATE)) // 7 AS age
      FROM t JOIN f ON t.dimension1 = f.dimension1)
SELECT {wk('first_date')} AS first_dt, CAST(isoyear(first_date) AS BIGINT) AS year, {', '.join(ages)}
FROM a GROUP BY 1, 2)
"""


def ledger_windows_sql(step: int) -> str:
    """Days under half of the mean rows of a day, and windows over each run of days
    without rows, by the I2 rule."""
    return f"""
SELECT * FROM (
WITH days AS (SELECT date AS day, COUNT(*) AS n FROM traffic WHERE date IS NOT NULL GROUP BY date),
free AS (SELECT CAST(c.day AS DATE) AS day FROM (SELECT UNNEST(generate_series(MIN(day), MAX(day), INTERVAL 1 DAY)) AS day FROM days) c
         WHERE CAST(c.day AS DATE) NOT IN (SELECT day FROM days)),
runs AS (SELECT MIN(day) AS s, MAX(day) AS e FROM (SELECT day, day - CAST(ROW_NUMBER() OVER (ORDER BY day) AS INTEGER) AS run FROM free)
         GROUP BY run),
cuts AS (SELECT s, e, GREATEST(CAST(CEIL((e - s) / {step}.0) AS INTEGER), 1) AS k FROM runs),
pieces AS (SELECT s, e, k, UNNEST(generate_series(0, k - 1)) AS i FROM cuts)
SELECT day AS window_start, day AS window_end, 'incomplete' AS reason FROM days
WHERE n * 2 * (SELECT COUNT(*) FROM days) < (SELECT SUM(n) FROM days)
UNION ALL
SELECT CASE WHEN i = k - 1 THEN s ELSE e - CAST(i * {step} + {step} - 1 AS INTEGER) END, e - CAST(i * {step} AS INTEGER), 'new' FROM pieces)
"""


def publish_sql(bodies: dict[str, str], columns: dict[str, tuple[str, ...]]) -> str:
    """Per published column the number of values, the total of the numbers
    and the characters of the other values, as text."""
    from trafficlens.plans.registry import DESTINATIONS

    ctes, parts = [], []
    for name, (book, sheet, anchor) in DESTINATIONS.items():
        ctes.append(f"p_{name} AS ({bodies[name]})")
        for c in columns[name]:
            text = f"CAST({c} AS VARCHAR)"
            number = f"TRY_CAST({text} AS DOUBLE)"
            parts.append(
                f"SELECT {s_(name)} AS report_name, {s_(book)} AS workbook, {s_(sheet)} AS sheet, {s_(anchor)} AS anchor, "
                f"{s_(c)} AS column_name, COUNT({c}) AS n_values, "
                f"CAST(SUM(CAST({number} AS DECIMAL(28, 4))) AS DOUBLE) AS number_total, "
                f"CAST(COALESCE(SUM(CASE WHEN {number} IS NULL THEN length({text}) END), 0) AS BIGINT) AS text_chars "
                f"FROM p_{name}")
    return "WITH " + ",\n".join(ctes) + "\n" + "\nUNION ALL\n".join(parts)


# Columns of every published report, in order.
PUBLISHED_COLUMNS: dict[str, tuple[str, ...]] = {
    "report_phone_clicks": ("week", "totalEvents", "dimension1"),
    "report_calls_by_campaign": ("week", "city", "eventlabel", "cpc_type", "tot_event", "u_event"),
    "report_mortgage": ("isoweek", "city", "totalEvents", "dimension1"),
    "report_claims": ("isoweek", "city", "totalEvents"),
    "report_registrations": ("isoweek", "totalEvents"),
    "report_registrations_section": ("isoweek", "totalEvents"),
    "report_monthly_users": ("month", "uniqs"),
    "report_deal_combined": ("isoweek", "od_us", "gd_us", "od_clicks", "gd_clicks"),
    "report_weekly_cost": ("isoweek", "start_week", "CITY", "COST"),
    "report_banners": ("isoweek", "product", "action_type", "card_serp", "bnrs", "un_users"),
    "report_vas_by_action": ("isoweek", "eventaction", "rashlop"),
    "report_retention": ("first_dt", "year", "New_per_week", *(f"week_{a}" for a in range(1, 53))),
    "report_vas_by_city": ("isoweek", "city", "tot", "un"),
}


def oracle_sql() -> dict[str, str]:
    bodies = _bodies()
    bodies["publish_registry"] = publish_sql(bodies, PUBLISHED_COLUMNS)
    return {key: with_fixtures(body) for key, body in bodies.items()}


__all__ = ["oracle_sql", "TESTDATA_LOADED_UNTIL"]
