"""Filters (F1-F15, S14). Each is ``(df, ...) -> DataFrame``.

Date and time bounds are compared on the raw column with a literal of the
column's own type, never on ``CAST(col)``: that keeps them parquet-pushable
(``PushedFilters``) and partition-prunable. ``LIKE '%x%'`` becomes
``contains`` (pushed as ``StringContains``); regexes stay a filter above the
scan.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Event tables hold the day of this column as ``date``.
EVENT_TIME = "dateHourMinute"


def _type_of(df: DataFrame, name: str) -> T.DataType:
    lowered = name.lower()
    for f in df.schema.fields:
        if f.name.lower() == lowered:
            return f.dataType
    raise KeyError(name)


def normalize_ts(value: str) -> str:
    """``'yyyy-mm-dd[Thh:mm:ss][ UTC]'`` -> ``'yyyy-mm-dd hh:mm:ss'`` (UTC wall clock)."""
    text = value.strip().removesuffix(" UTC").removesuffix("Z")
    if len(text) > 10 and text[10] == "T":
        text = text[:10] + " " + text[11:]
    return text if len(text) > 10 else text + " 00:00:00"


def _ts_literal(value: str, dtype: T.DataType) -> Column:
    text = normalize_ts(value)
    if isinstance(dtype, T.TimestampType):
        return F.lit(text + " UTC").cast("timestamp")
    return F.lit(text).cast("timestamp_ntz")


def bound_literal(df: DataFrame, name: str, value: str) -> Column:
    """A literal for comparing column ``name``: DATE, TIMESTAMP (UTC),
    TIMESTAMP_NTZ or STRING, matching the column's type."""
    dtype = _type_of(df, name)
    if isinstance(dtype, T.DateType):
        return F.lit(value[:10]).cast("date")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return _ts_literal(value, dtype)
    return F.lit(value)


def from_date(df: DataFrame, c: str, d: str) -> DataFrame:
    """``CAST(c AS DATE) >= d``. On a timestamp column this is
    ``c >= d 00:00:00`` (same rows, pushable)."""
    return _from_day(df, c, d).where(F.col(c) >= bound_literal(df, c, d[:10]))


def _from_day(df: DataFrame, c: str, bound: str) -> DataFrame:
    """With a lower bound on the event time, the same bound on ``date``, the day
    of that time, so that the scan prunes its partitions."""
    if c != EVENT_TIME or "date" not in df.columns:
        return df
    return df.where(F.col("date") >= F.lit(bound[:10]).cast("date"))


def from_ts(df: DataFrame, c: str, ts: str) -> DataFrame:
    """``c >= 'yyyy-mm-dd hh:mm:ss UTC'``."""
    return _from_day(df, c, ts).where(F.col(c) >= bound_literal(df, c, ts))


def after_date(df: DataFrame, c: str, d: str) -> DataFrame:
    """``CAST(c AS DATETIME) > 'd'`` -- strictly after midnight of ``d``."""
    dtype = _type_of(df, c)
    if isinstance(dtype, T.DateType):
        return df.where(F.col(c) > F.lit(d[:10]).cast("date"))
    return df.where(F.col(c) > bound_literal(df, c, d))


def before_date(df: DataFrame, c: str, d: str) -> DataFrame:
    """``CAST(c AS DATE) < d``: the exclusive upper bound of a date range."""
    return df.where(F.col(c) < bound_literal(df, c, d[:10]))


def url_contains(df: DataFrame, c: str, fragment: str) -> DataFrame:
    """``c LIKE '%fragment%'``."""
    return df.where(F.col(c).contains(fragment))


def url_excludes(df: DataFrame, c: str, fragment: str) -> DataFrame:
    """``c NOT LIKE '%fragment%'`` (NULL rows are dropped)."""
    return df.where(~F.col(c).contains(fragment))


def not_equal(df: DataFrame, c: str, value) -> DataFrame:
    """``c <> value`` (NULL rows are dropped)."""
    return df.where(F.col(c) != F.lit(value))


def regex_any(df: DataFrame, c: str, pattern: str) -> DataFrame:
    """Unanchored regex search (anchor with ``^`` in the pattern)."""
    return df.where(F.col(c).rlike(pattern))


def equals_any(df: DataFrame, c: str, values: Sequence) -> DataFrame:
    """``c = v1 OR c = v2 ...`` (pushed as ``In``)."""
    return df.where(F.col(c).isin(list(values)))


def not_null(df: DataFrame, c: str) -> DataFrame:
    """F10/F14/F15."""
    return df.where(F.col(c).isNotNull())


def positive(df: DataFrame, c: str) -> DataFrame:
    """F11."""
    return df.where(F.col(c) > 0)


def in_year(df: DataFrame, c: str, year: int) -> DataFrame:
    """``year(c) = year`` written as a date range so it is pushed down."""
    lo, hi = dt.date(year, 1, 1).isoformat(), dt.date(year + 1, 1, 1).isoformat()
    return before_date(from_date(df, c, lo), c, hi)


def having_positive(df: DataFrame, alias: str) -> DataFrame:
    """``HAVING alias > 0`` on an aggregate result."""
    return df.where(F.col(alias) > 0)


def filter_expr(df: DataFrame, clauses: Iterable[tuple[str, str]], ignore_case: bool = True) -> DataFrame:
    """AND of regex matches, the report API's ``a=~x;b=~y`` filter.

    The API's case rule is not stated by the source; ``ignore_case`` (default
    on) prefixes ``(?i)``.
    """
    flag = "(?i)" if ignore_case else ""
    cond = F.lit(True)
    for column, pattern in clauses:
        cond = cond & F.col(column).rlike(flag + pattern)
    return df.where(cond)


def parse_filter_expression(expr: str, prefix: str = "ga:") -> list[tuple[str, str]]:
    """Split the API filter string (``;``-joined ``name=~regex`` clauses, the
    only form the reports send) into ``(column, regex)`` pairs."""
    clauses = []
    for part in expr.split(";"):
        if "=~" not in part or "," in part:
            raise ValueError(f"unsupported filter clause: {part!r}")
        name, pattern = part.split("=~", 1)
        clauses.append((name.strip().removeprefix(prefix), pattern))
    return clauses
