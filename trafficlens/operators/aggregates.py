"""Aggregations (A1-A11) and sorts (O1-O2).

All are hash aggregates with a map-side partial step, so a hot group key is
collapsed inside each input partition before the shuffle. Exact distinct
counts shuffle on (group, value) first, which spreads a hot group across
tasks; ``approx=True`` opts into HyperLogLog++ where exactness is not needed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficlens.functions.columns import as_col


def _keys(keys) -> list:
    return [keys] if isinstance(keys, (str, Column)) else list(keys)


def sum_as_bigint(c) -> Column:
    return F.sum(as_col(c)).cast("bigint")


def agg_sum(df: DataFrame, keys, cols: Mapping[str, str]) -> DataFrame:
    """A1/A10: ``SUM(col) AS out`` per group; ``cols`` maps out -> col."""
    return df.groupBy(*_keys(keys)).agg(*[sum_as_bigint(c).alias(out) for out, c in cols.items()])


def distinct_count(c, approx: bool = False) -> Column:
    return (F.approx_count_distinct(as_col(c)) if approx else F.countDistinct(as_col(c))).cast("bigint")


def agg_distinct(df: DataFrame, keys, col: str, alias: str, approx: bool = False) -> DataFrame:
    """A2: ``COUNT(DISTINCT col)`` per group (exact by default)."""
    return df.groupBy(*_keys(keys)).agg(distinct_count(col, approx).alias(alias))


def agg_sum_distinct(df: DataFrame, keys, sum_col: str, sum_alias: str, distinct_col: str,
                     distinct_alias: str, approx: bool = False) -> DataFrame:
    """A3: SUM and COUNT(DISTINCT) in one aggregate (Spark plans the distinct
    part as a two-level aggregate)."""
    return df.groupBy(*_keys(keys)).agg(
        sum_as_bigint(sum_col).alias(sum_alias),
        distinct_count(distinct_col, approx).alias(distinct_alias),
    )


def max_date(df: DataFrame, c: str, alias: str = "max_date") -> DataFrame:
    """A5: global MAX (one row; partial max per partition, one tiny final task)."""
    return df.agg(F.max(c).alias(alias))


def dedupe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``GROUP BY`` with no aggregate == ``DISTINCT`` over ``cols``."""
    return df.select(*cols).distinct()


def agg_by(df: DataFrame, keys: Mapping[str, Column], aggs: Sequence[Column]) -> DataFrame:
    """Group by computed expressions, named by alias."""
    return df.groupBy(*[as_col(e).alias(a) for a, e in keys.items()]).agg(*aggs)


def second_level(df: DataFrame, keys: Sequence[str], sums: Mapping[str, str], ordered: bool = True) -> DataFrame:
    """Pandas-style ``groupby(keys).agg(out=(col, 'sum'))``: rows with a
    NULL key are dropped, output sorted by the keys (``ordered=False`` leaves
    the sort to the consumer)."""
    kept = df.dropna(subset=list(keys))
    out = agg_sum(kept, keys, sums)
    return out.orderBy(*keys) if ordered else out


def rounded_sum(c, digits: int = 2) -> Column:
    """``ROUND(SUM(c), digits)``. The values are summed with ten decimals,
    as DECIMAL so the result does not depend on the order the partial sums
    arrive in, and only the sum is rounded; returned as DOUBLE."""
    return F.round(F.sum(as_col(c).cast("decimal(28,10)")), digits).cast("double")


def sort_by(df: DataFrame, *keys) -> DataFrame:
    """O1/O2: ascending sort, NULLs first (the warehouse default)."""
    return df.orderBy(*[as_col(k).asc_nulls_first() for k in keys])
