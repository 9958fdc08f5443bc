"""Written tables in the shared checkpoint folder, and their removal; the
package itself for the executors' Python workers."""

from __future__ import annotations

import atexit
import io
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

import trafficlens
from trafficlens.session import checkpoint_root

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, once an application:
    its modules go to the executors as a zip file (``addPyFile``). Where the
    package was itself started from a zip file they already have it."""
    context = spark.sparkContext
    folder = os.path.dirname(trafficlens.__file__)
    if context.applicationId in _SHIPPED or not os.path.isdir(folder):
        return
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for at, _, names in sorted(os.walk(folder)):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(at, name)
                z.write(path, os.path.join("trafficlens", os.path.relpath(path, folder)))
    local = tempfile.mkdtemp(prefix="trafficlens-package-")  # the driver's file server reads it from here
    atexit.register(shutil.rmtree, local, ignore_errors=True)
    path = os.path.join(local, f"trafficlens-{uuid.uuid4().hex}.zip")
    with open(path, "wb") as out:
        out.write(packed.getvalue())
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)


_RESULTS: list[str] = []


def remove_results(spark: SparkSession) -> None:
    """Delete the result tables of this process; call it when they have been read."""
    while _RESULTS:
        remove(spark, _RESULTS.pop())


class Scratch:
    """Tables of one operator run under ``spark.checkpoint.dir``.

    ``keep`` writes a DataFrame and reads it back (lineage is cut, lost
    executors cost nothing); ``close`` removes all of them. The result that an
    operator hands on is written apart by ``result`` and outlives ``close``.
    """

    def __init__(self, spark: SparkSession, name: str):
        ship_package(spark)
        self.spark = spark
        self.name = name
        self.root = f"{checkpoint_root(spark).rstrip('/')}/trafficlens-llm/{name}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(f"{name}-{uuid.uuid4().hex[:8]}")
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, df: DataFrame) -> None:
        """Remove a kept table that no later step reads."""
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if self.root.rsplit("/", 1)[-1] in path:
                remove(self.spark, path)

    def result(self, df: DataFrame) -> DataFrame:
        """Write the result beside the scratch tables, remove those, return it."""
        path = f"{self.root}-result"
        df.write.parquet(path)
        _RESULTS.append(path)
        self.close()
        return self.spark.read.schema(df.schema).parquet(path)

    def outlive(self) -> None:
        """A lazy result still reads the kept tables: leave them to ``remove_results``."""
        _RESULTS.append(self.root)

    def close(self) -> None:
        remove(self.spark, self.root)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder through Spark's own file systems (any scheme)."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a table; other columns are never read."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)
