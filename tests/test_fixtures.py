"""The mart tables derived from the test data have the row counts FIXTURES.md
records (verified there on both engines at sf0.01)."""

from __future__ import annotations

from trafficlens.sources.fixtures import FIXTURE_SQL, derive_tables

# Row counts at sf0.01 as listed in FIXTURES.md section 3.
EXPECTED_SF001 = {
    "ev0": 10000, "raw_events": 10000, "s0": 4006, "sessions": 4322, "page_views": 1982,
    "users_dim": 4006, "traffic": 15000, "costs": 15000, "banners": 10000, "banner_hits": 10000,
}


def test_derived_tables_have_the_recorded_row_counts(spark):
    frames = derive_tables(spark, "/root/testdata/sf0.01", tuple(FIXTURE_SQL))
    assert {name: df.count() for name, df in frames.items()} == EXPECTED_SF001
