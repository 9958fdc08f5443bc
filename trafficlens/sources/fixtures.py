"""Logical mart tables derived from the generated test tables.

Each statement is one SQL text that runs unchanged on Spark and DuckDB; the
``{name}`` placeholders are bound to DataFrames in Spark (``spark.sql`` with
keyword DataFrames, so no session-global views) and to CTE names in the DuckDB
oracle. Everything here is projection, one de-duplication and one join, so the
derived tables grow with the inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Base test tables each derived table reads (by placeholder name).
BASE_TABLES = ("events", "orders", "customer")

FIXTURE_SQL: dict[str, str] = {
    "ev0": """
SELECT ts, user_id, event_type, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM {events}
""",
    "raw_events": """
SELECT CAST(ts AS DATE) AS date, ts AS dateHourMinute,
  CASE WHEN k=99 THEN NULL ELSE CAST(user_id*100 + EXTRACT(day FROM ts) AS STRING) END AS dimension4,
  CASE WHEN event_type='click' AND k%5=0 THEN 'ClCardSellPhoneClickTop'
       WHEN event_type='click' AND k%5=1 THEN 'ClSerpSellSecondVasPhoneClick'
       WHEN event_type='click' AND k%5=2 THEN 'ClCardSellSecondVasPhoneClickAll'
       WHEN event_type='click' AND k%5=3 THEN 'ClCardSellPhoneClickAll'
       WHEN event_type='click' THEN 'ClCardSellMortgageClick'
       WHEN event_type='signup' THEN 'NewRegSuccess'
       WHEN event_type='purchase' THEN 'claim_completed'
       WHEN event_type='view' AND k%2=0 THEN 'gd_start'
       WHEN event_type='view' THEN 'lk_onlinebuy_lp_header_buy_click' END AS eventlabel,
  CASE WHEN k%3=0 THEN 'FL' WHEN k%3=1 THEN 'P_AGENT' ELSE 'JUR' END AS eventcategory,
  CASE WHEN k%4=0 THEN 'noprefix' WHEN k%4=1 THEN '_empty' ELSE concat('act', CAST(k%7 AS STRING), '_x_y') END AS eventaction,
  CASE WHEN k%17=0 THEN '/link-registration' WHEN user_id%3=0 THEN '/moskva/nedvizhimost'
       WHEN user_id%3=1 THEN '/sankt-peterburg/x' ELSE '/ufa/nedvizhimost' END AS pagepath,
  1+k%3 AS totalEvents, CAST(1 AS BIGINT) AS uniqueEvents, 1+k%2 AS users
FROM {ev0}
""",
    "s0": """
SELECT CAST(ts AS DATE) AS date, user_id FROM {events} GROUP BY 1,2
""",
    "sessions": """
SELECT date, CAST(user_id*100 + EXTRACT(day FROM date) AS STRING) AS session_id,
  CASE WHEN user_id%11=0 THEN NULL ELSE CAST(user_id AS STRING) END AS user_id,
  CASE WHEN user_id%4=0 THEN 'https://h.example/about' WHEN user_id%4=1 THEN 'https://h.example/moskva/nedvizhimost'
       WHEN user_id%4=2 THEN 'https://h.example/leningradskaya-oblast/nedvizhimost'
       ELSE 'https://test.example/nedvizhimost' END AS landingpage,
  CASE WHEN user_id%5=0 THEN '(direct)' ELSE 'google' END AS utm_source,
  CASE WHEN user_id%6=0 THEN '(none)' ELSE 'cpc' END AS utm_medium,
  CASE WHEN user_id%19=0 THEN NULL WHEN user_id%7=0 THEN '(not set)' WHEN user_id%7=1 THEN 'second_msk' WHEN user_id%7=2 THEN 'new-building_spb'
       WHEN user_id%7=3 THEN 'second_new-building' ELSE 'brand' END AS utm_campaign
FROM {s0}
UNION ALL
SELECT date, CAST(user_id*100 + EXTRACT(day FROM date) AS STRING), CAST(user_id+100000 AS STRING),
  'https://h.example/kazan/nedvizhimost', 'yandex', 'cpc', 'brand'
FROM {s0} WHERE user_id%13=0
""",
    "page_views": """
SELECT CAST(ts AS DATE) AS date, ts AS dateHourMinute, CAST(user_id*100 + EXTRACT(day FROM ts) AS STRING) AS dimension4,
  CASE WHEN k%3=0 THEN '/services/deal/x' WHEN k%3=1 THEN '/guaranteed-deal' ELSE '/other' END AS pagepath
FROM {ev0} WHERE event_type='view'
""",
    "users_dim": """
SELECT date, CAST(user_id AS STRING) AS dimension1,
  CASE WHEN user_id%4=3 THEN 'not_authorized' WHEN user_id%9=0 THEN NULL ELSE 'authorized' END AS dimension2
FROM {s0}
""",
    "traffic": """
SELECT CAST(o_orderdate AS DATE) AS date,
  CASE WHEN o_custkey%10=0 THEN NULL ELSE CAST(o_custkey AS STRING) END AS dimension1,
  CASE WHEN o_orderkey%7=0 THEN '/x' ELSE '/nedvizhimost' END AS landingpagepath
FROM {orders}
""",
    "costs": """
SELECT CAST(o_orderdate AS DATE) AS date, c_mktsegment AS CITY,
  CASE WHEN o_orderkey%9=0 THEN CAST(0 AS DOUBLE)
       ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) + CAST(o_orderkey%97 AS DECIMAL(18,0)) * 0.0001 AS DOUBLE) END AS COSTS
FROM {orders} JOIN {customer} ON o_custkey=c_custkey
""",
    "banner_hits": """
SELECT CASE WHEN k%23=0 THEN NULL ELSE lpad(CAST(EXTRACT(week FROM ts) AS STRING),2,'0') END AS isoweek,
  CAST(CAST(ts AS DATE) AS STRING) AS date,
  CASE WHEN k%6=0 THEN 'Banner_SERP_protection_click' WHEN k%6=1 THEN 'banner_card_onlinebuy_view'
       WHEN k%6=2 THEN 'banner_guarantee_lk' WHEN k%6=3 THEN 'banner_onlinebuy_serp_view_click'
       WHEN k%6=4 THEN 'banner_card_other_click' ELSE 'banner_onlinebuy_guarantee_card_view' END AS eventlabel,
  'c' AS eventcategory, event_type AS eventaction, CAST(1+k%3 AS STRING) AS totalevents, 1+k%2 AS users,
  CASE WHEN user_id%3=0 THEN '/moskva/nedvizhimost' WHEN user_id%3=1 THEN '/blog/x' ELSE '/nedvizhimost/list' END
    AS pagepath
FROM {ev0}
""",
    "banners": """
SELECT isoweek, date, eventlabel, eventcategory, eventaction, totalevents, users FROM {banner_hits}
""",
}

# Placeholders each statement binds, in dependency order.
FIXTURE_DEPS: dict[str, tuple[str, ...]] = {
    "ev0": ("events",),
    "raw_events": ("ev0",),
    "s0": ("events",),
    "sessions": ("s0",),
    "page_views": ("ev0",),
    "users_dim": ("s0",),
    "traffic": ("orders",),
    "costs": ("orders", "customer"),
    "banner_hits": ("ev0",),
    "banners": ("banner_hits",),
}

LOGICAL = ("sessions", "raw_events", "page_views", "users_dim", "traffic", "costs", "banners", "banner_hits")


def read_base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def derive_tables(spark: SparkSession, sf_dir: str, names=LOGICAL) -> dict[str, DataFrame]:
    """Build the requested logical tables (and their helpers) as lazy DataFrames."""
    frames: dict[str, DataFrame] = {}

    def build(name: str) -> DataFrame:
        if name in frames:
            return frames[name]
        if name in BASE_TABLES:
            frames[name] = read_base(spark, sf_dir, name)
        else:
            bound = {dep: build(dep) for dep in FIXTURE_DEPS[name]}
            frames[name] = spark.sql(FIXTURE_SQL[name], **bound)
        return frames[name]

    return {name: build(name) for name in names}


def duckdb_ctes(names) -> str:
    """``WITH`` clause defining the given fixture tables (and helpers) for DuckDB."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in BASE_TABLES or name in order:
            return
        for dep in FIXTURE_DEPS[name]:
            visit(dep)
        order.append(name)

    for name in names:
        visit(name)
    identity = {n: n for n in (*BASE_TABLES, *FIXTURE_SQL)}
    parts = [f"{n} AS ({FIXTURE_SQL[n].strip().format(**identity)})" for n in order]
    return "WITH " + ",\n".join(parts) if parts else ""
