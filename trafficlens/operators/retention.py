"""Cohort retention.

The reference joins two derived tables of the same traffic: (week, user)
activity and each user's first week. Here both come out of **one** shuffle on
the user: per user, ``min(date)`` and the active ISO weeks as a 53-bit mask
(``bit_or``, partial-aggregated map-side, so even a user with a third of all
rows collapses before the shuffle). The mask is expanded back into
(user, week) rows, giving exactly the join's rows without a second shuffle or
a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficlens.functions.calendar import iso_week, iso_year, year_of
from trafficlens.functions.columns import as_col


def cohort_age(week, first_week, wrap: int = 52) -> Column:
    """P10: weeks since the first week, wrapping at ``wrap`` (faithful: a
    53-week year makes ages collide)."""
    w, f = as_col(week), as_col(first_week)
    return F.when(w < f, (F.lit(wrap) - f) + w).otherwise(w - f).cast("bigint")


def cohort_year(first_date, week52_year: int) -> Column:
    """The cohort's year; a first week of 52 is pinned to ``week52_year``."""
    d = as_col(first_date)
    return F.when(iso_week(d) == 52, F.lit(week52_year).cast("bigint")).otherwise(year_of(d))


def first_week(df: DataFrame, user: str = "dimension1", date: str = "date", week52_year: int = 2021) -> DataFrame:
    """A4: per user, the ISO week and cohort year of the first active date.
    NULL users form one group, as in SQL."""
    first = df.groupBy(user).agg(F.min(date).alias("_first"))
    return first.select(
        iso_week("_first").alias("first_dt"),
        cohort_year("_first", week52_year).alias("year"),
        F.col(user),
    )


def weekly_activity(df: DataFrame, user: str = "dimension1", date: str = "date") -> DataFrame:
    """The (iso_week, user) pairs with any activity (``GROUP BY 1,2``)."""
    return df.select(iso_week(date).alias("iso_week"), F.col(user)).distinct()


def cohort_members(df: DataFrame, user: str = "dimension1", date: str = "date",
                   week52_year: int = 2021) -> DataFrame:
    """(user, first_dt, year, iso_week) for every active week of every user,
    from one aggregate per user. NULL users are dropped (they never join)."""
    return members_of(user_weeks(df, user, date), user, week52_year)


def user_weeks(df: DataFrame, user: str = "dimension1", date: str = "date") -> DataFrame:
    """Per user the first active date and the active weeks: ``user, first_date, weeks``.

    The weeks (ISO weeks 1-53) are bits of one BIGINT: a fixed-width, codegen'd
    hash aggregate with 8 bytes of state per user (no object set)."""
    week_bit = F.pow(F.lit(2), iso_week(date)).cast("bigint")  # 2^w, exact for w <= 53
    return (df.where(F.col(user).isNotNull()).groupBy(user)
            .agg(F.min(date).alias("first_date"), F.bit_or(week_bit).alias("weeks")))


def merge_user_weeks(known: DataFrame, new: DataFrame, user: str = "dimension1") -> DataFrame:
    """Two ``user_weeks`` frames as one. Minimum and bit union do not mind order or
    repetition, so days can be merged late, twice or in any order."""
    return (known.unionByName(new).groupBy(user)
            .agg(F.min("first_date").alias("first_date"), F.bit_or("weeks").alias("weeks")))


def members_of(per_user: DataFrame, user: str = "dimension1", week52_year: int = 2021) -> DataFrame:
    """``user_weeks`` expanded to (user, first_dt, year, iso_week)."""
    members = per_user.select(
        F.col(user),
        iso_week("first_date").alias("first_dt"),
        cohort_year("first_date", week52_year).alias("year"),
        F.explode(F.expr("filter(sequence(1, 53), w -> ((weeks >> w) & 1) = 1)")).alias("_w"),
    )
    return members.select(user, "first_dt", "year", F.col("_w").cast("bigint").alias("iso_week"))


# Weeks in one word of ``user_week_words``: bits 0..62 of a BIGINT.
WORD_WEEKS = 63


def week_number(date) -> Column:
    """Weeks (from Monday) since the one that holds 1970-01-01: the same ISO week of
    two years has two numbers."""
    return F.floor((F.unix_date(as_col(date)) + 3) / 7).cast("bigint")


def user_week_words(df: DataFrame, user: str = "dimension1", date: str = "date") -> DataFrame:
    """Per user and word of 63 weeks the first date and the active weeks:
    ``user, word, first_date, weeks``. Fixed-width state, collapsed map-side; one row
    a user and 63 weeks, however many years the traffic covers."""
    numbered = df.where(F.col(user).isNotNull() & F.col(date).isNotNull()).select(
        user, date, F.floor(week_number(date) / WORD_WEEKS).cast("bigint").alias("word"),
        F.pmod(week_number(date), F.lit(WORD_WEEKS)).cast("int").alias("_bit"))
    return numbered.groupBy(user, "word").agg(F.min(date).alias("first_date"),
                                              F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("weeks"))


def exact_members(df: DataFrame, user: str = "dimension1", date: str = "date") -> DataFrame:
    """(user, first_dt, year, senior) for every active week of every user: ISO week and
    ISO year of the first date, and the true number of weeks since (no wrap)."""
    per_user = user_week_words(df, user, date).groupBy(user).agg(
        F.min("first_date").alias("_first"), F.collect_list(F.struct("word", "weeks")).alias("_words"))
    words = per_user.select(user, "_first", F.explode("_words").alias("_w"))
    active = words.select(user, "_first", F.col("_w.word").alias("_word"),
                          F.explode(F.expr(f"filter(sequence(0, {WORD_WEEKS - 1}), b -> ((_w.weeks >> b) & 1) = 1)"))
                          .alias("_bit"))
    return active.select(user, iso_week("_first").alias("first_dt"), iso_year("_first").alias("year"),
                         (F.col("_word") * WORD_WEEKS + F.col("_bit") - week_number("_first")).alias("senior"))


def cohort_pivot(df: DataFrame, max_age: int = 52) -> DataFrame:
    """Members per (first_dt, year) and age -> one column per age:
    ``New_per_week`` (age 0), ``week_1`` .. ``week_{max_age}``; 0 where empty.

    Pivot values are listed, so no extra job discovers them; the pivot first
    aggregates to (first_dt, year, age) counts, then folds ages into columns.
    """
    ages = list(range(max_age + 1))
    counted = df.groupBy("first_dt", "year").pivot("senior", ages).agg(F.count(F.lit(1)))
    names = ["New_per_week"] + [f"week_{a}" for a in ages[1:]]
    return counted.select(
        "first_dt", "year",
        *[F.coalesce(F.col(f"`{a}`"), F.lit(0)).cast("bigint").alias(n) for a, n in zip(ages, names)],
    )


def retention_matrix(traffic: DataFrame, week52_year: int, max_age: int = 52,
                     user: str = "dimension1", date: str = "date") -> DataFrame:
    """R13 core: cohort members -> age -> 53-column pivot (unordered)."""
    return matrix_of(cohort_members(traffic, user, date, week52_year), max_age)


def matrix_of(members: DataFrame, max_age: int = 52) -> DataFrame:
    """Cohort members -> age -> 53-column pivot (unordered)."""
    aged = members.select("first_dt", "year", cohort_age("iso_week", "first_dt").alias("senior"))
    return cohort_pivot(aged, max_age)
