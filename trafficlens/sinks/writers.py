"""Sinks (K1-K4).

``append`` adds rows, as the reference's table write does. ``replace_dates`` is
the form for loads that may be repeated: re-loading a window replaces that
window's dates instead of duplicating them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ("date",)) -> None:
    """K1: add rows to a persisted table, partitioned by ``partition_by``; all
    rows that are there stay.

    Rows are clustered by the partition columns with a ``REBALANCE`` hint, so
    each task writes few files while AQE splits a hot date (one date holding a
    large share of the rows) over several tasks instead of one.
    """
    cols = list(partition_by)
    df.hint("rebalance", *cols).write.mode("append").partitionBy(*cols).parquet(path)


def replace_dates(df: DataFrame, path: str, partition_by: Sequence[str] = ("date",)) -> None:
    """Write ``df`` in place of the partitions it has rows for; all others are
    kept (dynamic partition overwrite). A repeated load leaves the same table.
    Rows without a partition value are refused by the load before they get here."""
    cols = list(partition_by)
    (df.hint("rebalance", *cols).write
       .option("partitionOverwriteMode", "dynamic")
       .mode("overwrite")
       .partitionBy(*cols)
       .parquet(path))


def replace_days(df: DataFrame, path: str, days: Sequence[str], column: str = "date") -> None:
    """Write ``df`` in place of the given days: like ``replace_dates``, and a day that
    ``df`` has no row for is emptied. Repeating it leaves the same table."""
    replace_dates(df, path, (column,))
    spark = df.sparkSession
    to_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = to_path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stored = {s.getPath().getName() for s in fs.listStatus(to_path(path))} & {f"{column}={d}" for d in days}
    if stored:
        written = {r[0] for r in df.select(column).distinct().collect()}
        for name in stored - {f"{column}={d}" for d in written}:
            fs.delete(to_path(f"{path}/{name}"), True)


def as_view(df: DataFrame, name: str) -> None:
    """K2: replace a temp view used by the next SQL step."""
    df.createOrReplaceTempView(name)


def report_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """K3: the report in its published column order (the header row is the
    column names)."""
    return df.select(*(columns or df.columns))


def write_matrix(df: DataFrame, path: str, order: Sequence[str] = ()) -> None:
    """Write a report as CSV with a header row, rows in ``order``.

    The rows are range-partitioned by ``order``, so a long report is sorted by
    several tasks and its part files follow one another; a short one (the usual
    case) ends up as one file. Without ``order`` the frame must already be sorted.
    """
    out = report_matrix(df)
    out = out.withColumns({name: plain_number(F.col(name)) for name, kind in out.dtypes if kind == "double"})
    if order:
        out = out.orderBy(*[F.col(c).asc_nulls_first() for c in order])
    out.write.mode("overwrite").option("header", True).option("nullValue", "").csv(path)


def plain_number(c: Column) -> Column:
    """A double as plain decimal text (no exponent), up to ten decimals."""
    text = c.cast("decimal(38,10)").cast("string")
    return F.regexp_replace(text, r"\.?0+$", "")


def read_matrix(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).csv(path)
