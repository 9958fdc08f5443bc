"""SparkSession construction and shared-storage helpers."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every report relies on. Time zone: the warehouse literals are UTC.
# Case-insensitive resolution: the reference mixes `totalEvents` / `totalevents`.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.caseSensitive": "false",
}

# Scale settings: AQE re-plans joins from runtime sizes (broadcast only when the
# measured side is under the threshold), splits skewed join partitions and
# coalesces small shuffle partitions.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "trafficlens",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the settings the reports assume.

    ``shuffle_partitions``: on a cluster size it to about total shuffle bytes /
    200 MB (AQE coalesces downwards); locally use the core count.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {**SCALE_CONF, **REQUIRED_CONF, "spark.ui.enabled": "false"}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_required_conf(spark)
    return spark


def ensure_required_conf(spark: SparkSession) -> None:
    """Apply the session-level settings the reports depend on (idempotent).

    Used by the driver entry points, which receive a session built elsewhere.
    """
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    for key in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled"):
        if spark.conf.get(key, "true") != "true":
            spark.conf.set(key, "true")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session; only when it is unset on a local master (tests, a
    laptop) a private folder is created and registered. On a cluster an unset
    setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        current = spark.sparkContext.getCheckpointDir()
        if current:
            return current
        if not spark.sparkContext.master.startswith("local"):
            # A machine-local folder is not shared by the executors of a cluster.
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster "
                               "(e.g. on HDFS or an object store)")
        configured = tempfile.mkdtemp(prefix="trafficlens-ckpt-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/trafficlens/{name}-{uuid.uuid4().hex}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for local-filesystem helpers (tests only)."""
    return path[len("file:"):] if path.startswith("file:") else os.fspath(path)
