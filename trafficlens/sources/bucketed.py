"""Session and event tables stored bucketed by the session id.

Tables of the catalog with the same number of buckets on the same key join, and group
by that key, without an exchange: at 100 TB the reports then move only what is left
after their aggregates. The tables keep their ``date`` partitions, so date bounds prune
as before.

A bucketed scan reads each bucket in one task, and a shuffle-free join cannot be split
by AQE. So the rows of every bucket are counted when a table is written, and a table
whose largest bucket holds more than ``max_skew`` times the mean (one hot session) is
read as plain parquet: its joins shuffle, and AQE splits the hot partition.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficlens.sources.mart import Mart
from trafficlens.sources.schemas import TABLES, check_schema

SESSION_KEYS: dict[str, str] = {"sessions": "session_id", "raw_events": "dimension4", "page_views": "dimension4"}
MAX_SKEW = 4.0


def _counts_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}_buckets"


def write_bucketed(spark: SparkSession, frames: Mapping[str, DataFrame], database: str, root: str, buckets: int) -> None:
    """Write the session-keyed tables of ``frames`` under ``root`` as tables of
    ``database``, partitioned by date, bucketed and sorted by the session id; beside each,
    the row count of its buckets. A (bucket, date) is written by one task as one file, so
    a hot session is spread over its days."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for name, key in SESSION_KEYS.items():
        if name not in frames:
            continue
        bucket = F.pmod(F.hash(key), F.lit(buckets))  # as bucketBy deals rows
        df = check_schema(frames[name], name)
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}`")
        (df.repartition(bucket, "date").write.mode("overwrite").format("parquet").partitionBy("date")
         .bucketBy(buckets, key).sortBy(key).option("path", f"{root.rstrip('/')}/{name}")
         .saveAsTable(f"`{database}`.`{name}`"))
        (spark.table(f"`{database}`.`{name}`").groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("rows"))
         .withColumn("buckets", F.lit(buckets)).coalesce(1).write.mode("overwrite").parquet(_counts_path(root, name)))


def bucket_skew(spark: SparkSession, root: str, name: str) -> float:
    """Rows of the table's largest bucket over the mean of all its buckets (1 for an empty table)."""
    counts = spark.read.schema("bucket int, rows bigint, buckets int").parquet(_counts_path(root, name))
    skew = counts.agg(F.max("rows") * F.max("buckets") / F.sum("rows")).first()[0]
    return 1.0 if skew is None else float(skew)


def with_bucketed(spark: SparkSession, mart: Mart, database: str, root: str, max_skew: float = MAX_SKEW) -> Mart:
    """``mart`` with the bucketed tables in place of its own; those with a hot bucket
    are read as plain parquet of the same files."""
    for name in SESSION_KEYS:
        if not spark.catalog.tableExists(f"`{database}`.`{name}`"):
            continue
        if bucket_skew(spark, root, name) <= max_skew:
            df = spark.table(f"`{database}`.`{name}`")
        else:
            df = spark.read.schema(TABLES[name]).parquet(f"{root.rstrip('/')}/{name}")
        mart = mart.with_table(name, df.select(*TABLES[name].names))
    return mart
