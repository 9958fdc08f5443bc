"""Session settings and the shared scratch folder."""

from __future__ import annotations

from trafficlens.session import REQUIRED_CONF, checkpoint_root, ensure_required_conf, scratch_path


def test_scratch_lives_under_the_configured_checkpoint_dir(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir")
    root = checkpoint_root(spark)
    assert configured and root.rstrip("/").endswith(configured.rstrip("/").removeprefix("file:"))
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root.rstrip("/") + "/trafficlens/x-")


def test_required_conf_is_applied_to_a_foreign_session(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        ensure_required_conf(spark)
        for key, value in REQUIRED_CONF.items():
            assert spark.conf.get(key) == value
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
