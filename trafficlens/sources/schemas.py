"""Explicit schemas of the logical mart tables and of a landed report-API page.

Types follow the casts and comparisons the reports apply. Event timestamps are
``TIMESTAMP_NTZ`` holding UTC wall-clock time (the warehouse literals end in
``UTC``); a ``TIMESTAMP`` column also works when the session time zone is UTC.
The two event tables carry ``date``, the day of ``dateHourMinute``, which they
are partitioned by.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

S, L, D, DT, NTZ = T.StringType(), T.LongType(), T.DateType(), T.DoubleType(), T.TimestampNTZType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


SESSIONS = _struct(
    ("date", D), ("session_id", S), ("user_id", S), ("landingpage", S),
    ("utm_source", S), ("utm_medium", S), ("utm_campaign", S),
)
RAW_EVENTS = _struct(
    ("date", D), ("dateHourMinute", NTZ), ("dimension4", S), ("eventlabel", S), ("eventcategory", S),
    ("eventaction", S), ("pagepath", S), ("totalEvents", L), ("uniqueEvents", L), ("users", L),
)
PAGE_VIEWS = _struct(("date", D), ("dateHourMinute", NTZ), ("dimension4", S), ("pagepath", S))
USERS_DIM = _struct(("date", D), ("dimension1", S), ("dimension2", S))
TRAFFIC = _struct(("date", D), ("dimension1", S), ("landingpagepath", S))
COSTS = _struct(("date", D), ("CITY", S), ("COSTS", DT))
BANNERS = _struct(
    ("isoweek", S), ("date", S), ("eventlabel", S), ("eventcategory", S),
    ("eventaction", S), ("totalevents", S), ("users", L),
)

# The banner table as the incremental load writes it: API dimension names with
# the ``ga:`` prefix stripped, ``users`` cast by the connector, ``totalevents``
# left as text (the connector's exact-name cast list does not include it), and
# the ISO ``date`` partition column.
LOADED_BANNERS = _struct(
    ("isoweek", S), ("eventLabel", S), ("eventCategory", S), ("eventAction", S),
    ("totalevents", S), ("users", L), ("date", S),
)

# Banner events before the report request: with the page path its filter reads.
BANNER_HITS = _struct(*[(f.name, f.dataType) for f in BANNERS.fields], ("pagepath", S))

TABLES: dict[str, T.StructType] = {
    "sessions": SESSIONS,
    "raw_events": RAW_EVENTS,
    "page_views": PAGE_VIEWS,
    "users_dim": USERS_DIM,
    "traffic": TRAFFIC,
    "costs": COSTS,
    "banners": BANNERS,
    "banner_hits": BANNER_HITS,
}

# One landed report-API page: the request window and page token the extractor
# used, plus the response body (``reports`` as the API returns it).
REPORT_BODY = T.ArrayType(
    _struct(
        ("columnHeader", _struct(
            ("dimensions", T.ArrayType(S)),
            ("metricHeader", _struct(
                ("metricHeaderEntries", T.ArrayType(_struct(("name", S), ("type", S)))),
            )),
        )),
        ("data", _struct(
            ("rows", T.ArrayType(_struct(
                ("dimensions", T.ArrayType(S)),
                ("metrics", T.ArrayType(_struct(("values", T.ArrayType(S))))),
            ))),
            ("rowCount", L),
            ("isDataGolden", T.BooleanType()),
            ("samplesReadCounts", T.ArrayType(S)),
        )),
    )
)
REPORT_ROWS = REPORT_BODY.elementType["data"].dataType["rows"].dataType
REPORT_PAGE = _struct(("startDate", S), ("endDate", S), ("pageToken", S), ("reports", REPORT_BODY))


class SchemaMismatch(ValueError):
    pass


def check_schema(df: DataFrame, name: str) -> DataFrame:
    """Verify ``df`` carries every declared column of table ``name`` with its
    declared type (names compared case-insensitively) and project it to the
    declared names and order."""
    expected = TABLES[name]
    actual = {f.name.lower(): f for f in df.schema.fields}
    problems = []
    for field in expected.fields:
        got = actual.get(field.name.lower())
        if got is None:
            problems.append(f"missing {field.name}")
        elif got.dataType != field.dataType:
            problems.append(f"{field.name}: {got.dataType.simpleString()} != {field.dataType.simpleString()}")
    if problems:
        raise SchemaMismatch(f"table {name}: " + "; ".join(problems))
    return df.select(*[df[actual[f.name.lower()].name].alias(f.name) for f in expected.fields])
