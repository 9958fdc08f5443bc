from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
from trafficlens.llm import queries as q

SF = "/root/testdata/sf0.001"


def test_registered():
    names = [n for n in entry.queries() if n.startswith("op") or n == "pipeline"]
    assert {n.split("_")[0] for n in names} == {f"op{i}" for i in range(1, 14)} | {"pipeline"}


@pytest.mark.parametrize("name", sorted(q.oracle_sql()))
def test_oracle_parity(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    want = con.execute(q.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    df = q.queries()[name](spark, SF)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(str, (tuple(r[c] for c in columns) for r in df.collect()))) == sorted(map(str, want.fetchall()))
