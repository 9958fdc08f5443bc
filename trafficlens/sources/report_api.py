"""Report-API pages.

The extractor lands each API response page as one JSON record (request
window, page token, response body), one directory per request window start.
Reading is a plain schema'd JSON scan, so pages are input splits and all
windows are read as one union; a filter on the window start prunes
directories; nothing is requested serially from the driver. The requested dimensions
and metrics give the columns; each page's response header says where they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trafficlens.sources.schemas import REPORT_PAGE

# Rows the extractor asks for at a time.
PAGE_SIZE = 10_000


def read_report_pages(spark: SparkSession, path: str, multi_line: bool = False,
                      layout: str = "windows") -> DataFrame:
    """Every landed page under ``path``, one row per page.

    ``layout="windows"`` (default): pages land in one directory per request
    window start (``startDate=YYYY-MM-DD/``, or flat); ``startDate`` is a
    partition column, so a filter on it reads only those windows' files.
    ``layout="any"``: arbitrary nesting, every file found recursively.
    ``multi_line``: each file is one pretty-printed response instead of JSON lines.
    ``landed`` and ``landed_file`` say when the page's file was written and which it is.
    """
    reader = spark.read.schema(REPORT_PAGE).option("multiLine", multi_line)
    if layout == "windows":
        reader = reader.option("basePath", path)
    elif layout == "any":
        reader = reader.option("recursiveFileLookup", "true")
    else:
        raise ValueError(f"unknown layout {layout!r}")
    return reader.json(path).select("*", F.col("_metadata.file_modification_time").alias("landed"),
                                    F.col("_metadata.file_path").alias("landed_file"))


def _named(names: Column, values: Column, name: str, kind: str) -> Column:
    """The value under ``name`` in the response header; fails on a page whose
    header has no such name (a page without rows is not looked at)."""
    at = F.array_position(names, name)
    missing = F.raise_error(F.concat(F.lit(f"report page without {kind} {name}: header has "),
                                     F.coalesce(F.array_join(names, ", "), F.lit("no names"))))
    return F.when(F.coalesce(at, F.lit(0)) == 0, missing.cast("string")) \
        .otherwise(F.get(values, (at - 1).cast("int")))


def flatten_report(pages: DataFrame, dimensions: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """One flat row per report row, columns named as requested. Every
    value is taken by the names in its page's response header, so a response with
    its columns in another order is read right and one without a requested column
    fails. A page without rows yields no rows; the columns are still there."""
    body = F.col("reports")[0]
    header = body["columnHeader"]
    rows = pages.select(header["dimensions"].alias("d"),
                        F.transform(header["metricHeader"]["metricHeaderEntries"], lambda e: e["name"]).alias("m"),
                        F.explode(body["data"]["rows"]).alias("r"))
    dims = [_named(F.col("d"), F.col("r.dimensions"), n, "dimension").alias(n) for n in dimensions]
    mets = [_named(F.col("m"), F.col("r.metrics")[0]["values"], n, "metric").alias(n) for n in metrics]
    return rows.select(*dims, *mets)


def current_pages(pages: DataFrame) -> DataFrame:
    """The newest landing of every page: a page that was asked for again replaces
    its earlier landings. Newest by ``landed`` (``read_report_pages`` takes it from
    the file), then by file name, then by content; frames without these columns are
    told apart by content. One shuffle by (window, token), groups of a few pages."""
    order = [F.col(c).desc_nulls_last() for c in ("landed", "landed_file") if c in pages.columns]
    newest = Window.partitionBy("startDate", "endDate", page_offset("pageToken"), "pageToken").orderBy(
        *order, F.xxhash64(F.to_json("reports")))
    return pages.withColumn("_landing", F.row_number().over(newest)).where(F.col("_landing") == 1).drop("_landing")


def page_offset(token) -> Column:
    """Row offset that a page token stands for: no token is the first page; NULL for
    a token that is no offset."""
    c = F.col(token) if isinstance(token, str) else token
    offset = F.when(c.isNull() | (F.trim(c) == ""), F.lit(0)).otherwise(F.trim(c).try_cast("bigint")).cast("bigint")
    return F.when(offset >= 0, offset)


def page_coverage(pages: DataFrame) -> DataFrame:
    """S10 and S11 of every request window, by the row offsets its pages cover.

    The rows of a page lie at ``[offset, offset + n)``. In offset order a running
    maximum of the ends tells gaps from overlaps, so a page that landed twice does
    not make up for one that is missing. Only the newest landing of a page counts;
    bodies are cut to their sizes before anything is shuffled. Columns:

    ``startDate, endDate, pages`` (current ones), ``superseded`` (landings replaced
    by newer ones), ``expected_rows`` (the largest announced count), ``landed_rows``,
    ``covered_rows`` (distinct offsets below the announced count), ``overlap_rows``
    (offsets under more than one page, or past the announced count), ``unplaced``
    (pages whose token is no offset), ``missing`` (the uncovered ``[first, stop)``
    ranges, in order), ``complete``, ``golden``, ``newest_landing`` (time of the newest
    file, where known).
    """
    body = F.col("reports")[0]["data"]
    window = ["startDate", "endDate"]
    order = [F.col(c).desc_nulls_last() for c in ("landed", "landed_file") if c in pages.columns]
    light = pages.select(
        *window, page_offset("pageToken").alias("first"), F.col("pageToken").alias("token"),
        F.when(body["rows"].isNull(), 0).otherwise(F.size(body["rows"])).cast("bigint").alias("n"),
        F.coalesce(body["rowCount"], F.lit(0)).cast("bigint").alias("announced"),
        (body["isDataGolden"].isNotNull() & body["samplesReadCounts"].isNull()).alias("golden"),
        (F.col("landed") if "landed" in pages.columns else F.lit(None)).cast("timestamp").alias("landed"),
        F.row_number().over(Window.partitionBy(*window, page_offset("pageToken"), "pageToken").orderBy(
            *order, F.xxhash64(F.to_json("reports")))).alias("landing"))
    current = light.where(F.col("landing") == 1)
    replaced = light.groupBy(*window).agg(F.count_if(F.col("landing") > 1).cast("bigint").alias("superseded"),
                                         F.max("landed").alias("newest_landing"))
    before = Window.partitionBy(*window).orderBy("first", "n").rowsBetween(Window.unboundedPreceding, -1)
    placed = (current
              .withColumn("whole", F.max("announced").over(Window.partitionBy(*window)))
              .withColumn("stop", F.col("first") + F.col("n"))
              .withColumn("reached", F.coalesce(F.max("stop").over(before), F.lit(0)))
              .withColumn("fresh", F.greatest(F.lit(0), F.least("stop", "whole") - F.greatest("first", "reached")))
              .withColumn("gap", F.when((F.col("first") > F.col("reached")) & (F.col("reached") < F.col("whole")),
                                        F.struct(F.col("reached").alias("first"),
                                                 F.least("first", "whole").alias("stop")))))
    out = placed.groupBy(*window).agg(
        F.count(F.lit(1)).cast("bigint").alias("pages"),
        F.max("announced").alias("expected_rows"), F.sum("n").cast("bigint").alias("landed_rows"),
        F.coalesce(F.sum("fresh"), F.lit(0)).cast("bigint").alias("covered_rows"),
        F.count_if(F.col("first").isNull()).cast("bigint").alias("unplaced"),
        F.coalesce(F.sum(F.when(F.col("first").isNotNull(), F.col("n"))), F.lit(0)).cast("bigint").alias("placed_rows"),
        F.coalesce(F.max("stop"), F.lit(0)).alias("last"), F.sort_array(F.collect_list("gap")).alias("gaps"),
        F.bool_and("golden").alias("golden"))
    tail = F.when(F.col("last") < F.col("expected_rows"),
                  F.array(F.struct(F.col("last").alias("first"), F.col("expected_rows").alias("stop"))))
    out = (out.join(replaced, window)
           .withColumn("overlap_rows", F.col("placed_rows") - F.col("covered_rows"))
           .withColumn("missing", F.when(tail.isNull(), F.col("gaps")).otherwise(F.concat("gaps", tail)))
           .withColumn("complete", (F.col("covered_rows") == F.col("expected_rows"))
                       & (F.col("overlap_rows") == 0) & (F.col("unplaced") == 0)))
    return out.select(*window, "pages", "superseded", "expected_rows", "landed_rows", "covered_rows", "overlap_rows",
                      "unplaced", "missing", "complete", "golden", "newest_landing")


def missing_requests(coverage: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """The requests that would complete the windows of ``page_coverage``:
    ``startDate, endDate, pageToken, page_size``, one row a page to ask for. Ranges
    are asked for in pages of up to ``page_size`` rows; a window with overlapping or
    unplaced pages is asked for anew from its first row on."""
    anew = (F.col("overlap_rows") > 0) | (F.col("unplaced") > 0)
    whole = F.array(F.struct(F.lit(0).cast("bigint").alias("first"), F.greatest("expected_rows", F.lit(1)).alias("stop")))
    ranges = coverage.where(~F.col("complete")).select(
        "startDate", "endDate", F.explode(F.when(anew, whole).otherwise(F.col("missing"))).alias("r"))
    starts = ranges.select("startDate", "endDate", F.col("r.stop").alias("stop"),
                           F.explode(F.sequence(F.col("r.first"), F.col("r.stop") - 1, F.lit(page_size))).alias("at"))
    return starts.select("startDate", "endDate", F.col("at").cast("string").alias("pageToken"),
                         F.least(F.lit(page_size), F.col("stop") - F.col("at")).cast("bigint").alias("page_size"))


def page_completeness(pages: DataFrame) -> DataFrame:
    """Per request window ``pages, expected_rows, landed_rows, complete`` (see
    ``page_coverage``)."""
    return page_coverage(pages).select("startDate", "endDate", "pages", "expected_rows", "landed_rows", "complete")


def quality_flag(pages: DataFrame) -> DataFrame:
    """A page is golden when the response carries ``isDataGolden`` and no
    ``samplesReadCounts`` (key presence, as the reference tests). Every page
    is tested; per window, golden means all of its pages are."""
    body = F.col("reports")[0]["data"]
    per_page = pages.select(
        "startDate", "endDate", "pageToken",
        (body["isDataGolden"].isNotNull() & body["samplesReadCounts"].isNull()).alias("golden"),
    )
    return per_page.groupBy("startDate", "endDate").agg(
        F.bool_and("golden").alias("golden"),
        F.count(F.lit(1)).cast("bigint").alias("pages"),
    )


def window_status(pages: DataFrame) -> DataFrame:
    """S10 and S11 of every request window: ``pages``, ``expected_rows``,
    ``landed_rows``, ``golden``, ``complete`` (see ``page_coverage``)."""
    return page_coverage(pages).select("startDate", "endDate", "pages", "expected_rows", "landed_rows", "golden", "complete")
