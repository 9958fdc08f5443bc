"""Incremental load of report-API pages into a date-partitioned table.

Batch form: high-water mark of the target -> request windows -> pages ->
flatten -> typed rows -> dates replaced. Streaming form: the landed page
directory as a file stream with an ``availableNow`` trigger, into a table of its own
(``stream_landed_pages``, exactly-once file sink) or into the batch form's table
(``stream_windows``, whole windows put in place).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trafficlens.functions.calendar import parse_compact_date, parse_iso_date
from trafficlens.functions.columns import cast_metrics, normalize_columns
from trafficlens.params import INTEGER_METRICS
from trafficlens.sinks.writers import replace_dates, replace_days
from trafficlens.sources.report_api import current_pages, flatten_report, page_coverage, read_report_pages
from trafficlens.sources.schemas import REPORT_PAGE


def _date_lit(value) -> Column:
    if isinstance(value, Column):
        return value.cast("date")
    if isinstance(value, dt.date):
        value = value.isoformat()
    return F.lit(str(value)[:10]).cast("date")


def high_water_mark(target: DataFrame, default_start, today, date_col: str = "date") -> DataFrame:
    """One row ``(max_date, start_date, end_date)``: the load starts the
    day after the newest loaded date (``default_start`` for an empty target)
    and ends yesterday. ``today`` is an argument, not the clock."""
    d = F.col(date_col)
    as_date = parse_iso_date(d) if dict(target.dtypes)[date_col] == "string" else d.cast("date")
    return target.agg(F.max(as_date).alias("max_date")).select(
        "max_date",
        F.coalesce(F.date_add("max_date", 1), _date_lit(default_start)).alias("start_date"),
        F.date_sub(_date_lit(today), 1).alias("end_date"),
    )


def windows_between(bounds: DataFrame, step: int, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """I2 over a frame of ``(start, end)`` rows: windows of ``step`` days,
    oldest first, columns ``window_start, window_end``.

    Rule: working back from ``end``, a window is ``[d - step + 1, d]`` while
    ``d - step > start``, the oldest one is ``[start, d]`` (so it may be longer
    than ``step``). ``start == end`` gives one window (the reference gives
    none and then fails); ``start > end`` gives none.
    """
    if step < 1:
        raise ValueError("step must be >= 1")
    s, e = F.col(start), F.col(end)
    n = F.datediff(e, s)
    k = F.when(n < 0, 0).when(n == 0, 1).otherwise(F.ceil(n / F.lit(step))).cast("int")
    idx = F.when(k > 0, F.sequence(F.lit(0), k - 1)).otherwise(F.array().cast("array<int>"))
    numbered = bounds.select(s.alias("_s"), e.alias("_e"), k.alias("_k"), F.explode(idx).alias("_i"))
    w_end = F.date_sub(F.col("_e"), F.col("_i") * step)
    w_start = F.when(F.col("_i") == F.col("_k") - 1, F.col("_s")).otherwise(F.date_sub(w_end, step - 1))
    # One row per window (bounded by the days requested): ordered inside a
    # single partition, so no sampling sort runs each time the frame is used.
    return (numbered.select(w_start.alias("window_start"), w_end.alias("window_end"))
            .coalesce(1).sortWithinPartitions("window_start"))


def date_windows(spark: SparkSession, start, end, step: int = 1) -> DataFrame:
    """I2 for literal bounds."""
    bounds = spark.range(1).select(_date_lit(start).alias("start_date"), _date_lit(end).alias("end_date"))
    return windows_between(bounds, step)


def typed_report_rows(pages: DataFrame, dimensions: Sequence[str], metrics: Sequence[str],
                      integer_metrics: Sequence[str] = INTEGER_METRICS, malformed: str = "fail") -> DataFrame:
    """Connector typing: flatten, strip the ``ga:`` prefix, cast the
    integer metrics listed by exact name, parse ``yyyymmdd`` dates; the date
    is stored as ISO text, the target table's type.

    A date or integer metric that does not parse stops the job with its text
    (``malformed="fail"``, as the reference does). ``"keep"`` leaves those rows
    out of the result and ``"reject"`` returns only them, as text.
    """
    flat = normalize_columns(flatten_report(pages, dimensions, metrics), prefix="ga:")
    numbers = [c for c in flat.columns if c in integer_metrics]
    bad = F.lit(False)
    if "date" in flat.columns:
        bad = bad | parse_compact_date("date").isNull()
    for c in numbers:
        bad = bad | (F.col(c).isNotNull() & F.col(c).try_cast("bigint").isNull())
    if malformed == "reject":
        return flat.where(bad)
    if malformed == "keep":
        flat = flat.where(~bad)
    elif malformed != "fail":
        raise ValueError(f"malformed: {malformed!r}")
    if "date" in flat.columns:
        text = F.coalesce(F.col("date"), F.lit("no date"))
        flat = flat.withColumn("date", F.coalesce(
            F.date_format(parse_compact_date("date"), "yyyy-MM-dd"),
            F.raise_error(F.concat(F.lit("malformed date: "), text)).cast("string")))
    return cast_metrics(flat, numbers)


def partition_values(spark: SparkSession, path: str, column: str = "date") -> list[str]:
    """The partition values of a stored table, from the folder listing alone (no file
    is opened); the NULL partition is left out."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory()]
    values = [n.split("=", 1)[1] for n in names if n.startswith(f"{column}=")]
    return sorted(v for v in values if not v.startswith("__HIVE"))


def newest_partition(spark: SparkSession, path: str, column: str = "date") -> str | None:
    """I1 of a stored table: its newest partition value (``partition_values``). None
    for a table without partitions or files."""
    return max(partition_values(spark, path, column), default=None)


def load_bounds(spark: SparkSession, target: str, default_start, today) -> tuple[dt.date, dt.date]:
    """First and last day to request: the day after the target's newest date (or
    ``default_start``) and yesterday."""
    newest = newest_partition(spark, target)
    as_date = lambda v: v if isinstance(v, dt.date) else dt.date.fromisoformat(str(v)[:10])
    start = as_date(newest) + dt.timedelta(days=1) if newest else as_date(default_start)
    return start, as_date(today) - dt.timedelta(days=1)


def incremental_append(
    spark: SparkSession,
    target: str,
    fetch_pages: Callable[[DataFrame, dt.date, dt.date], DataFrame],
    dimensions: Sequence[str],
    metrics: Sequence[str],
    default_start,
    today,
    step: int = 1,
    inspect: Callable[[DataFrame], None] | None = None,
    rejects: str | None = None,
) -> tuple[dt.date, dt.date]:
    """Load every window after the target's newest date.

    ``fetch_pages(windows, first, last)`` returns the pages of those request
    windows (a schema'd JSON scan of the landing area in production).
    ``inspect(pages)``, if given, sees the pages before anything is written
    (quality and completeness checks; raising stops the load). Rows that do not
    parse stop the load, or go to the table ``rejects`` if one is named. The
    windows lie after the newest date, so nothing that is there is touched; a
    repeated load of the same days replaces them. Returns the days asked for.
    """
    first, last = load_bounds(spark, target, default_start, today)
    if first > last:  # up to date: nothing to request, nothing to write
        return first, last
    pages = fetch_pages(date_windows(spark, first, last, step), first, last)
    if inspect is not None:
        inspect(pages)
    if rejects is not None:
        typed_report_rows(pages, dimensions, metrics, malformed="reject").write.mode("append").parquet(rejects)
    rows = typed_report_rows(pages, dimensions, metrics, malformed="fail" if rejects is None else "keep")
    replace_dates(rows, target)
    return first, last


def stream_landed_pages(
    spark: SparkSession,
    landing_dir: str,
    target: str,
    checkpoint_location: str,
    dimensions: Sequence[str],
    metrics: Sequence[str],
) -> StreamingQuery:
    """I3, streaming form: every page file that lands under ``landing_dir`` is
    flattened, typed and written once to ``target`` (parquet, partitioned by
    date). The file sink's commit log makes each micro-batch exactly-once
    across restarts; ``availableNow`` processes the backlog and stops."""
    pages = (spark.readStream.schema(REPORT_PAGE)
             .option("recursiveFileLookup", "true")
             .json(landing_dir))
    rows = typed_report_rows(pages, dimensions, metrics)  # a row that does not parse stops the stream
    return (rows.writeStream.format("parquet")
            .option("path", target)
            .option("checkpointLocation", checkpoint_location)
            .partitionBy("date")
            .trigger(availableNow=True)
            .start())


def stream_windows(
    spark: SparkSession,
    landing_dir: str,
    target: str,
    checkpoint_location: str,
    dimensions: Sequence[str],
    metrics: Sequence[str],
    incomplete: str = "load",
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """I3, streaming form that shares its table with the batch form: page files that
    land name the request windows to load, and each micro-batch puts the days of those
    windows in place (``foreachBatch``, ``replace_days``).

    What a window's days hold is decided by all its landed pages (the newest landing of
    each), never by the micro-batch alone: a batch that is run again after a crash, or
    a batch load of the same windows before, between or after, leaves the same rows.
    Of windows that share a day the one with the newest landing gives it.
    ``incomplete="leave"`` waits for windows whose pages do not cover the announced rows.
    Rows dated outside their window stop the stream. ``availableNow`` takes the
    backlog, ``files_per_batch`` files at a time, and stops."""
    if incomplete not in ("load", "leave"):
        raise ValueError(f"incomplete: {incomplete!r}")

    def load(batch: DataFrame, _batch_id: int) -> None:
        starts = [r[0] for r in batch.select("startDate").distinct().collect()]  # at most a window a file
        if not starts:
            return
        pages = read_report_pages(batch.sparkSession, landing_dir).where(F.col("startDate").isin(starts))
        wanted = page_coverage(pages).select("startDate", "endDate", "complete", "newest_landing").collect()
        known = [r for r in wanted if r["complete"] or incomplete == "load"]
        for layer in window_layers(known):
            load_windows(pages, layer)

    def load_windows(pages: DataFrame, windows: list) -> None:
        days = sorted({day for r in windows for day in days_of(r["startDate"], r["endDate"])})
        asked = F.lit(False)
        for r in windows:
            asked = asked | ((F.col("startDate") == F.lit(r["startDate"])) & (F.col("endDate") == F.lit(r["endDate"])))
        rows = typed_report_rows(current_pages(pages.where(asked)), dimensions, metrics)
        outside = F.raise_error(F.concat(F.lit("row outside its window: "), F.col("date"))).cast("string")
        replace_days(rows.withColumn("date", F.when(F.col("date").isin(days), F.col("date")).otherwise(outside)),
                     target, days)

    pages = (spark.readStream.schema(REPORT_PAGE).option("basePath", landing_dir)
             .option("maxFilesPerTrigger", files_per_batch).json(landing_dir))
    return (pages.writeStream.foreachBatch(load)
            .option("checkpointLocation", checkpoint_location)
            .trigger(availableNow=True)
            .start())


def days_of(first, last) -> list[str]:
    """ISO days from ``first`` to ``last``."""
    a, b = (dt.date.fromisoformat(str(v)[:10]) for v in (first, last))
    return [(a + dt.timedelta(days=k)).isoformat() for k in range((b - a).days + 1)]


def window_layers(windows: list) -> list[list]:
    """Windows in groups to load one after another: by landing time, and windows that
    share a day are in different groups, the newest landing last. Usually one group."""
    layers: list[list] = []
    held: list[set[str]] = []
    for r in sorted(windows, key=lambda r: (r["newest_landing"], str(r["startDate"]), str(r["endDate"]))):
        days = set(days_of(r["startDate"], r["endDate"]))
        at = 1 + max((k for k, other in enumerate(held) if other & days), default=-1)
        if at == len(layers):
            layers.append([])
            held.append(set())
        layers[at].append(r)
        held[at] |= days
    return layers
