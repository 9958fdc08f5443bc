"""Every catalog key on Spark against its DuckDB oracle at sf0.001: row count,
column names and an order-insensitive value hash."""

from __future__ import annotations

import os
import re

import duckdb
import pytest

import __spark_entry__ as entry
from scripts.check_oracle import TABLES, digest
from trafficlens.plans.catalog import queries as catalog_queries

SF = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()
KEYS = sorted(catalog_queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        path = f"{SF}/{t}.parquet"
        if os.path.exists(path):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return c


def test_every_key_has_an_oracle_or_is_rows_only():
    from trafficlens.plans.catalog import ROWS_ONLY
    assert set(KEYS) <= set(SQL) | set(ROWS_ONLY)


def test_entry_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["week", "totalEvents", "dimension1"]
    assert df.count() >= 0


@pytest.mark.parametrize("key", KEYS)
def test_key_matches_oracle(spark, con, key):
    df = entry.queries()[key](spark, SF)
    got = [tuple(r) for r in df.collect()]
    plan = df._jdf.queryExecution().executedPlan().toString()
    # JVM-only, and nothing that pairs rows without a key
    assert not re.search(r"(BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas"
                         r"|CartesianProduct|BroadcastNestedLoopJoin)", plan)
    if key not in SQL:
        assert len(got) > 0
        return
    cur = con.execute(SQL[key])
    want_cols = [c[0] for c in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(want_cols)
    assert len(got) == len(want)
    assert digest(df.columns, got) == digest(want_cols, want)


def test_every_survey_key_is_registered_with_an_oracle():
    from scripts.coverage import survey_rows

    keys = [k for _, _, ks in survey_rows() for k in ks]
    assert len(keys) >= 100
    # Pages, their completeness and their quality flag are tested on page files
    # (test_ingest.py, test_cli.py): no table of the test data holds such pages.
    on_files = {"report_pages", "page_completeness", "quality_flag"}
    assert [k for k in keys if k not in on_files and (k not in entry.queries() or k not in SQL)] == []
