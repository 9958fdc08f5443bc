from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from trafficlens.session import build_session

    extra = {}
    # Tests set their own shared folder only when the environment names none.
    from pyspark import SparkConf
    if not SparkConf().get("spark.checkpoint.dir", None):
        extra["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="trafficlens-test-ckpt-")
    session = build_session("local[4]", app_name="trafficlens-tests", shuffle_partitions=4, extra_conf=extra)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def scratch(spark):
    from trafficlens.session import scratch_path
    return lambda name: scratch_path(spark, name)


def rows(df):
    return [tuple(r) for r in df.collect()]
