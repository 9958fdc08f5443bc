"""The mart: logical table name -> DataFrame, with schemas checked at read.

Production layout: one parquet directory per table under a root, partitioned or
sorted by ``date``, so date bounds prune files. Tests and
the driver use ``Mart.from_testdata``, which derives the same tables from the
generated parquet files.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from trafficlens.sources import fixtures
from trafficlens.sources.schemas import TABLES, check_schema

# Storage layout of the mart: tables with many rows a day are partitioned by the
# calendar date. The two tables with few rows a day are range-partitioned and
# sorted by date instead, so that a date bound skips files and row groups by
# their statistics without a folder for each day.
SORTED_COLUMNS: dict[str, str] = {"traffic": "date", "costs": "date"}
PARTITION_COLUMNS: dict[str, str] = {name: "date" for name in TABLES if name not in SORTED_COLUMNS}


class Mart:
    def __init__(self, frames: Mapping[str, DataFrame]):
        self._frames = {name: check_schema(df, name) for name, df in frames.items()}

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str, names: Iterable[str] = TABLES) -> "Mart":
        """Read ``{root}/{name}`` with the declared schema (no inference)."""
        root = root.rstrip("/")
        return cls({n: spark.read.schema(TABLES[n]).parquet(f"{root}/{n}") for n in names})

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str, names: Iterable[str] = fixtures.LOGICAL) -> "Mart":
        """The mart derived lazily from the test tables (recomputed by every query)."""
        return cls(fixtures.derive_tables(spark, sf_dir, tuple(names)))

    @classmethod
    def written(cls, spark: SparkSession, frames: Mapping[str, DataFrame], root: str) -> "Mart":
        """Write ``frames`` as the production layout under ``root`` (one parquet
        directory per table, partitioned or sorted by ``date``) and read them
        back: later queries scan stored tables, with pruning and no lineage
        back to the derivation."""
        root = root.rstrip("/")

        def write(name: str) -> None:
            df = check_schema(frames[name], name)
            part, order = PARTITION_COLUMNS.get(name), SORTED_COLUMNS.get(name)
            if part:
                df.hint("rebalance", part).write.mode("overwrite").partitionBy(part).parquet(f"{root}/{name}")
            else:
                df.repartitionByRange(order).sortWithinPartitions(order).write.mode("overwrite") \
                    .parquet(f"{root}/{name}")

        # The tables are independent: submit their writes as concurrent jobs.
        with ThreadPoolExecutor(max_workers=len(frames) or 1) as pool:
            list(pool.map(write, list(frames)))
        return cls.from_parquet(spark, root, list(frames))

    def table(self, name: str, columns: Iterable[str] | None = None) -> DataFrame:
        """Scan a table projecting only ``columns`` (pruned at the scan)."""
        df = self._frames[name]
        return df.select(*columns) if columns is not None else df

    def with_table(self, name: str, df: DataFrame) -> "Mart":
        frames = dict(self._frames)
        frames[name] = df
        return Mart(frames)

    def __contains__(self, name: str) -> bool:
        return name in self._frames


def load(spark: SparkSession, root: str, name: str, columns: Iterable[str] | None = None) -> DataFrame:
    """Scan one logical table stored as parquet under ``root``."""
    return Mart.from_parquet(spark, root, [name]).table(name, columns)
