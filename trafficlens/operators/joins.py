"""Joins (J1-J6).

All report joins are equi-joins on a session or user key. The physical choice
is left to Catalyst + AQE: both sides are first reduced to the join grain
(de-duplicated / pre-aggregated, which collapses hot keys map-side), then
shuffled on the key; AQE turns the join into a broadcast when a side's
*measured* size is under ``autoBroadcastJoinThreshold`` and splits skewed
partitions otherwise. No side is broadcast on a guess.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def join_events(
    sessions: DataFrame,
    events: DataFrame,
    how: str = "left",
    require: str | None = None,
    session_key: str = "session_id",
    event_key: str = "dimension4",
    on_week: str | None = None,
) -> DataFrame:
    """Sessions ``how``-join events on session id (and optionally on a
    week column present on both sides), then keep rows where ``require`` (a
    column of the optional side) is not NULL.

    The NULL test makes the outer join an inner one; Catalyst rewrites it
    (``EliminateOuterJoin``). ``on_week`` names the week column on both sides;
    the event side's copy is kept under that name.
    """
    cond = sessions[session_key] == events[event_key]
    if on_week:
        s = sessions.withColumnRenamed(on_week, "_s_week")
        cond = (s[session_key] == events[event_key]) & (s["_s_week"] == events[on_week])
        joined = s.join(events, cond, how).drop("_s_week")
    else:
        joined = sessions.join(events, cond, how)
    if require:
        joined = joined.where(F.col(require).isNotNull())
    return joined


def chain_left(
    views: DataFrame,
    sessions: DataFrame,
    users: DataFrame,
    how: str = "left",
) -> DataFrame:
    """Page views -> sessions on (session id, date) -> users on (user id, date).

    Column contract: ``views(date, dimension4, ...)``,
    ``sessions(date, session_id, user_id, ...)``, ``users(date, dimension1, ...)``.
    Output keeps the user side's columns prefixed ``u_``. With a later
    ``HAVING count > 0`` the left chain equals the inner chain, which is what
    the reports pass (Catalyst does not infer that rewrite itself).
    """
    s = sessions.select(*[F.col(c).alias(f"s_{c}") for c in sessions.columns])
    u = users.select(*[F.col(c).alias(f"u_{c}") for c in users.columns])
    vs = views.join(s, (views["dimension4"] == s["s_session_id"]) & (views["date"] == s["s_date"]), how)
    return vs.join(u, (vs["s_user_id"] == u["u_dimension1"]) & (vs["s_date"] == u["u_date"]), how)


def join_cohort(activity: DataFrame, first: DataFrame, key: str = "dimension1") -> DataFrame:
    """Implicit (comma + WHERE) join of two derived tables: an inner
    equi-join, NULL keys never match."""
    return activity.join(first, on=key, how="inner")


def stack_frames(frames: Sequence[DataFrame], key: str) -> tuple[DataFrame, list[str]]:
    """Long form ``(_frame, _key, value columns...)`` of separate frames; each
    row carries only its own frame's values (the others are NULL)."""
    value_cols = [c for f in frames for c in f.columns if c != key]
    if len(set(value_cols)) != len(value_cols):
        raise ValueError(f"value columns must be distinct: {value_cols}")
    tagged = [f.select(F.lit(i).alias("_frame"), F.col(key).alias("_key"),
                       *[F.col(c) for c in f.columns if c != key])
              for i, f in enumerate(frames)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged), value_cols


def combine_stacked(long: DataFrame, key: str, value_cols: Sequence[str], how: str = "position") -> DataFrame:
    """J6 over the long form: frame 0's key, then every value column.

    ``position``: row *i* of every frame lands on row *i* (each frame ordered
    by key ascending, NULLs first); only frame 0's key is kept, so a week
    missing in one frame shifts its rows, as the reference's positional concat
    does. ``key``: rows with equal key side by side (a full outer join on it;
    NULL keys never pair up).

    One aggregate folds the frames (no joins); the position numbering is a
    window partitioned by frame, and each frame is a weekly aggregate (at most
    54 rows).
    """
    if how not in ("position", "key"):
        raise ValueError(f"unknown combine mode {how!r}")
    values = [F.first(c, ignorenulls=True).alias(c) for c in value_cols]
    if how == "key":
        group = F.when(F.col("_key").isNull(), F.col("_frame")).alias("_null_frame")
        out = long.groupBy("_key", group).agg(*values)
        return out.select(F.col("_key").alias(key), *value_cols)
    pos = F.row_number().over(Window.partitionBy("_frame").orderBy(F.col("_key").asc_nulls_first()))
    out = long.withColumn("_pos", pos).groupBy("_pos").agg(
        F.first(F.when(F.col("_frame") == 0, F.col("_key")), ignorenulls=True).alias(key), *values)
    return out.orderBy("_pos").select(key, *value_cols)


def combine(frames: Sequence[DataFrame], key: str = "isoweek", how: str = "position") -> DataFrame:
    """Put report frames (unique keys, distinct value columns) side by
    side, by position or by key; see ``combine_stacked``."""
    if not frames:
        raise ValueError("nothing to combine")
    long, value_cols = stack_frames(frames, key)
    return combine_stacked(long, key, value_cols, how)


def combine_wide(weekly: DataFrame, key: str, frames: Sequence[tuple[str, Column]], how: str = "position") -> DataFrame:
    """J6 where the frames are columns of one weekly aggregate ``weekly`` (unique
    keys): frame *i* is ``(key, frames[i][0])`` on the rows where ``frames[i][1]``
    holds. The same result as ``combine`` over the single frames.

    ``position`` gathers the aggregate in one row (at most 54 weeks, or as many as
    the keys tell apart), sorts each frame there and deals the positions out again,
    in order: one exchange of the weekly rows. ``key`` needs none.
    """
    if how not in ("position", "key"):
        raise ValueError(f"unknown combine mode {how!r}")
    names = [name for name, _ in frames]
    kept = [F.coalesce(keep, F.lit(False)) for _, keep in frames]
    if how == "key":
        def row(flags: Sequence[Column]) -> Column:
            return F.struct(reduce(lambda a, b: a | b, flags).alias("_any"),
                            *[F.when(k, F.col(n)).alias(n) for n, k in zip(names, flags, strict=True)])

        alone = [row([k if i == j else F.lit(False) for j, k in enumerate(kept)]) for i in range(len(kept))]
        # NULL keys never pair up: a frame's NULL week is a row of its own
        rows = F.when(F.col(key).isNull(), F.array(*alone)).otherwise(F.array(row(kept)))
        out = weekly.select(key, F.explode(rows).alias("_r")).where(F.col("_r._any"))
        return out.select(key, *[F.col(f"_r.{n}").alias(n) for n in names])
    lists = [F.sort_array(F.collect_list(F.when(k, F.struct(F.col(key).alias("key"), F.col(n).alias("value"))))).alias(n)
             for n, k in zip(names, kept, strict=True)]
    whole = weekly.groupBy().agg(*lists)
    rows = F.greatest(*[F.size(n) for n in names]) if len(names) > 1 else F.size(names[0])
    places = whole.select("*", F.explode(F.when(rows > 0, F.sequence(F.lit(0), rows - 1))).alias("_at"))
    return places.select(F.get(F.col(names[0]), F.col("_at"))["key"].alias(key),
                         *[F.get(F.col(n), F.col("_at"))["value"].alias(n) for n in names])
