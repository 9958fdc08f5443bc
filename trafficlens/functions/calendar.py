"""Calendar expressions (all built-in, JVM-side).

Weeks are ISO weeks without a year, as in the reference: grouping by week
merges the same week of different years unless the caller adds ``iso_year``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trafficlens.functions.columns import as_col


def to_date_col(c) -> Column:
    """``CAST(x AS DATE)``."""
    return as_col(c).cast("date")


def to_datetime_col(c) -> Column:
    """``CAST(x AS DATETIME)`` -- a timestamp without time zone."""
    return as_col(c).cast("timestamp_ntz")


def iso_week(c) -> Column:
    """ISO week number (1-53) of a date or timestamp, as BIGINT."""
    return F.weekofyear(as_col(c)).cast("bigint")


def iso_year(c) -> Column:
    """Year the ISO week belongs to (opt-in companion of ``iso_week``)."""
    return F.extract(F.lit("YEAROFWEEK"), as_col(c)).cast("bigint")


def month_of(c) -> Column:
    """P5."""
    return F.month(as_col(c)).cast("bigint")


def year_of(c) -> Column:
    """P6."""
    return F.year(as_col(c)).cast("bigint")


def iso_week_monday(week, year) -> Column:
    """Monday of ISO week ``week`` of ``year``.

    Week 1 is the week holding January 4th; ``weekday`` is 0 for Monday.
    """
    y = as_col(year).cast("int") if not isinstance(year, int) else F.lit(year)
    jan4 = F.make_date(y, F.lit(1), F.lit(4))
    week1 = F.date_sub(jan4, F.weekday(jan4))
    return F.date_add(week1, ((as_col(week) - 1) * 7).cast("int"))


def parse_compact_date(c) -> Column:
    """``yyyyMMdd`` text -> DATE (NULL when malformed)."""
    return F.try_to_date(as_col(c), "yyyyMMdd")


def parse_iso_date(c) -> Column:
    """``yyyy-MM-dd`` text -> DATE (NULL when malformed)."""
    return F.try_to_date(as_col(c), "yyyy-MM-dd")
