"""The window ledger of the incremental load (I1, I3): which request windows are in
the target, and which have to be asked for (again).

A high-water mark knows only the newest date. The ledger is a small append-only
table with one row a window and step of a load, so a window that failed, never
landed, or came incomplete or sampled is asked for until it is whole, wherever it
lies. A load writes in this order:

1. ``started`` rows of the windows it is about to write (``absent`` rows of those
   that have not landed),
2. the rows, in place of the dates of these windows,
3. ``loaded`` rows with what was found.

After a crash between any two steps the windows' newest row is not ``loaded``, so
the next load writes their dates again; the target ends the same.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trafficlens.sinks.writers import replace_days
from trafficlens.sources.report_api import page_coverage
from trafficlens.streaming.incremental import newest_partition, partition_values, typed_report_rows, windows_between

LEDGER = T.StructType([
    T.StructField("window_start", T.DateType()), T.StructField("window_end", T.DateType()),
    T.StructField("state", T.StringType()),        # started, absent, loaded
    T.StructField("rows", T.LongType()), T.StructField("expected_rows", T.LongType()),
    T.StructField("complete", T.BooleanType()), T.StructField("golden", T.BooleanType()),
    T.StructField("newest_landing", T.TimestampType()),
    T.StructField("load_id", T.StringType()),
    T.StructField("step", T.LongType()),           # microseconds; later rows of a window win
])


def ledger_path(target: str) -> str:
    return f"{target.rstrip('/')}_ledger"


def exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    if not exists(spark, path):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(path)


def record(spark: SparkSession, path: str, rows: Sequence[tuple]) -> None:
    """Append the rows of one step (``LEDGER`` without ``step``), as one file."""
    now = time.time_ns() // 1000
    spark.createDataFrame([(*r, now) for r in rows], LEDGER).coalesce(1).write.mode("append").parquet(path)


def latest(ledger: DataFrame) -> DataFrame:
    """The newest row of every window."""
    rest = [c for c in LEDGER.names if c not in ("window_start", "window_end")]
    return (ledger.groupBy("window_start", "window_end")
            .agg(F.max_by(F.struct(*rest), F.struct("step", F.col("state") == "loaded", "load_id")).alias("r"))
            .select("window_start", "window_end", "r.*"))


def wanted_windows(ledger: DataFrame, start, end, step: int = 1) -> DataFrame:
    """``window_start, window_end, reason`` to ask for between two days, oldest first:
    recorded windows whose newest row is not a whole, unsampled load, with the bounds
    they had (``reason`` is ``unfinished``, ``absent``, ``incomplete`` or ``sampled``),
    and the days that no window covers (``new``), cut into windows by the I2 rule
    within each run of consecutive days."""
    bounds = [d if isinstance(d, Column) else F.lit(str(d)[:10]).cast("date") for d in (start, end)]
    newest = latest(ledger)
    again = newest.where(F.col("window_end").between(*bounds)).select(
        "window_start", "window_end",
        F.when(F.col("state") == "started", "unfinished").when(F.col("state") == "absent", "absent")
        .when(~F.coalesce("complete", F.lit(False)), "incomplete")
        .when(~F.coalesce("golden", F.lit(False)), "sampled").alias("reason")).where(F.col("reason").isNotNull())
    covered = newest.select(F.explode(F.sequence("window_start", "window_end")).alias("day")).distinct()
    calendar = ledger.sparkSession.range(1).select(*[b.alias(n) for b, n in zip(bounds, "se", strict=True)]) \
        .where("s <= e").select(F.explode(F.sequence("s", "e")).alias("day"))
    # one row a calendar day: the numbering without a partition is over a few thousand rows
    free = calendar.join(covered, "day", "left_anti").withColumn(
        "run", F.date_sub("day", F.row_number().over(Window.orderBy("day")).cast("int")))
    runs = free.groupBy("run").agg(F.min("day").alias("start_date"), F.max("day").alias("end_date"))
    new = windows_between(runs, step).withColumn("reason", F.lit("new"))
    return again.unionByName(new).orderBy("window_start")


def seed_from_target(spark: SparkSession, target: str, ledger: str) -> None:
    """A target that was loaded without a ledger: its dates count as whole loads. Runs
    once, before the first step is recorded; a table that a ledger load began always
    has a ledger, so a crashed first load is never taken for such a target."""
    if exists(spark, ledger) or newest_partition(spark, target) is None:
        return
    days = [dt.date.fromisoformat(v) for v in partition_values(spark, target)]
    record(spark, ledger, [(d, d, "loaded", None, None, True, True, None, "seed") for d in days])


def ledger_load(
    spark: SparkSession, target: str, ledger: str,
    fetch_pages: Callable[[DataFrame, dt.date, dt.date], DataFrame],
    dimensions: Sequence[str], metrics: Sequence[str], default_start, today, step: int = 1,
    check: Callable[[list], None] | None = None, incomplete: str = "load", rejects: str | None = None,
) -> dict:
    """I3 with a ledger: load every wanted window up to yesterday.

    ``check(statuses)`` sees one row a landed window (``page_coverage``) before
    anything is written; raising stops the load. ``incomplete="load"`` writes the rows
    of incomplete windows, ``"leave"`` leaves their dates as they are; both ask for
    them again next time. A window that was loaded before and of which nothing newer
    has landed is left alone. Rows dated outside the windows stop the load. Returns
    ``windows`` (statuses), ``loaded`` (days written) and ``absent`` (windows without
    pages). Only window rows (calendar-sized) reach the driver.
    """
    if incomplete not in ("load", "leave"):
        raise ValueError(f"incomplete: {incomplete!r}")
    seed_from_target(spark, target, ledger)
    last = dt.date.fromisoformat(str(today)[:10]) - dt.timedelta(days=1)
    known = read_ledger(spark, ledger)
    wanted = wanted_windows(known, default_start, last, step).collect()
    out: dict = {"windows": [], "loaded": [], "absent": []}
    if not wanted:
        return out
    windows = spark.createDataFrame([(w.window_start, w.window_end) for w in wanted], "window_start date, window_end date")
    pages = fetch_pages(windows, wanted[0].window_start, max(w.window_end for w in wanted))
    out["windows"] = statuses = page_coverage(pages).orderBy("startDate").collect()
    if check is not None:
        check(statuses)
    found = {(dt.date.fromisoformat(s.startDate), dt.date.fromisoformat(s.endDate)): s for s in statuses}
    before = {(r.window_start, r.window_end): r.newest_landing for r in latest(known).where("state = 'loaded'").collect()}
    out["absent"] = [(w.window_start, w.window_end) for w in wanted if (w.window_start, w.window_end) not in found]
    chosen = {w: s for w, s in found.items() if (s.complete or incomplete == "load")
              and not (w in before and before[w] is not None and before[w] == s.newest_landing)}
    load_id = uuid.uuid4().hex
    unknown = {(w.window_start, w.window_end) for w in wanted if w.reason == "new"}
    steps = [(*w, "absent", None, None, None, None, None, load_id) for w in out["absent"] if w in unknown]
    steps += [(*w, "absent", s.landed_rows, s.expected_rows, s.complete, s.golden, None, load_id)
              for w, s in found.items() if w in unknown and w not in chosen]
    steps += [(*w, "started", s.landed_rows, s.expected_rows, s.complete, s.golden, s.newest_landing, load_id)
              for w, s in chosen.items()]
    if steps:
        record(spark, ledger, steps)
    if not chosen:
        return out
    days = sorted({a + dt.timedelta(days=i) for a, b in chosen for i in range((b - a).days + 1)})
    picked = spark.createDataFrame([(str(a), str(b)) for a, b in chosen], "startDate string, endDate string")
    pages = pages.join(picked, ["startDate", "endDate"], "left_semi")
    if rejects is not None:
        typed_report_rows(pages, dimensions, metrics, malformed="reject").write.mode("append").parquet(rejects)
    rows = typed_report_rows(pages, dimensions, metrics, malformed="fail" if rejects is None else "keep")
    known_day = F.col("date").isin([d.isoformat() for d in days])
    rows = rows.withColumn("date", F.when(known_day, F.col("date")).otherwise(
        F.raise_error(F.concat(F.lit("row dated outside the requested windows: "), F.col("date"))).cast("string")))
    replace_days(rows, target, [d.isoformat() for d in days])
    record(spark, ledger, [(*w, "loaded", s.landed_rows, s.expected_rows, s.complete, s.golden, s.newest_landing, load_id)
                           for w, s in chosen.items()])
    out["loaded"] = days
    return out
