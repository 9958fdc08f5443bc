"""Run-and-publish registry.

Every published report has a destination: (workbook, sheet, anchor cell). Here
each destination is one output directory holding the report as CSV with a
header row. The directories of a root form a snapshot set: a run computes all
reports into a fresh folder and one commit makes them the current ones, so a run
that fails or is killed at any step leaves the whole old set, and a reader that
holds a version sees reports of one run only (``published``).
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficlens.params import ReportParams
from trafficlens.plans import reports as rp
from trafficlens.session import scratch_path
from trafficlens.sinks.snapshots import Snapshot, SnapshotSet
from trafficlens.sinks.writers import read_matrix, write_matrix
from trafficlens.sources.mart import Mart

# Neutral default destinations (workbook, sheet, anchor); pass your own mapping.
DESTINATIONS: dict[str, tuple[str, str, str]] = {
    "report_phone_clicks": ("traffic", "source", "U2"),
    "report_calls_by_campaign": ("traffic", "source", "BB2"),
    "report_mortgage": ("traffic", "source", "CA2"),
    "report_claims": ("traffic", "source", "CE2"),
    "report_registrations": ("traffic", "source", "CH2"),
    "report_registrations_section": ("traffic", "source", "CJ2"),
    "report_monthly_users": ("traffic", "source", "AV2"),
    "report_deal_combined": ("traffic", "source", "AF2"),
    "report_weekly_cost": ("traffic", "source", "BO2"),
    "report_banners": ("traffic", "source", "Y2"),
    "report_vas_by_action": ("calls", "source", "A1"),
    "report_retention": ("retention", "main", "A1"),
    "report_vas_by_city": ("traffic", "source", "BT2"),
}
Destinations = Mapping[str, tuple[str, str, str]]


def publish(report_name: str, df: DataFrame, root: str) -> str:
    """K4: write one report under ``root``; returns the path."""
    path = f"{root.rstrip('/')}/{report_name}"
    write_matrix(df, path, rp.REPORT_ORDER.get(report_name, ()))
    return path


def shared_event_table(mart: Mart, params: ReportParams) -> Mart:
    """The mart with ``raw_events`` replaced by the rows any report reads
    (``report_events``), written once as a table in the shared checkpoint
    folder: the reports scan that instead of the whole event table, and the
    written table cuts the lineage (a lost executor re-reads, not re-scans)."""
    subset = rp.report_events(mart, params)
    spark = subset.sparkSession
    path = scratch_path(spark, "report-events")
    subset.hint("rebalance", "date").write.partitionBy("date").parquet(path)
    return mart.with_table("raw_events", spark.read.schema(subset.schema).parquet(path))


def publish_all(mart: Mart, params: ReportParams, root: str, share_events: bool = True,
                destinations: Destinations = DESTINATIONS) -> DataFrame:
    """Compute every report with a destination into a fresh folder, then make
    them all current by one commit (other reports of the set stay). Returns what was published, read
    back: ``report_name, workbook, sheet, anchor, column_name, n_values,
    number_total, text_chars`` (``published_values``). ``share_events``: scan the
    event table once for all reports (``shared_event_table``)."""
    spark = mart.table("sessions").sparkSession
    versions = SnapshotSet(spark, root)
    base = versions.snapshot()
    if share_events:
        mart = shared_event_table(mart, params)
    staged = versions.stage()
    frames = {name: rp.REPORTS[name](mart, params) for name in destinations}
    for name, df in frames.items():
        publish(name, df, f"{versions.root}/{staged}")
    done = versions.commit(base, {name: f"{staged}/{name}" for name in frames}, info={"operation": "publish"})
    return reduce(DataFrame.unionByName, [
        published_values(read_matrix(spark, done.path(name)), name, destinations[name]) for name in frames])


def published(spark: SparkSession, root: str, version: int | None = None) -> Snapshot:
    """The published reports as of now, or of a version: ``path(name)`` is a report's
    directory, and stays readable while newer runs publish."""
    return SnapshotSet(spark, root).snapshot(version)


def published_values(report: DataFrame, name: str, destination: tuple[str, str, str]) -> DataFrame:
    """One row a column of a published report: how many values it has, the total
    of those that are numbers and the characters of those that are not."""
    cells = report.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in report.columns]))
        .alias("c")).select("c.column_name", "c.value")
    number = F.col("value").try_cast("double")
    book, sheet, anchor = destination
    return cells.groupBy("column_name").agg(
        F.count("value").cast("bigint").alias("n_values"),
        F.sum(number.cast("decimal(28,4)")).cast("double").alias("number_total"),
        F.coalesce(F.sum(F.when(number.isNull(), F.length("value"))), F.lit(0)).cast("bigint").alias("text_chars"),
    ).select(F.lit(name).alias("report_name"), F.lit(book).alias("workbook"), F.lit(sheet).alias("sheet"),
             F.lit(anchor).alias("anchor"), "column_name", "n_values", "number_total", "text_chars")
