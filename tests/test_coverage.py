"""Page coverage by offsets (S10): gaps, overlaps, double landings, requests for the rest."""

from __future__ import annotations

import os
import random

import pytest
from pages import day_rows, page, write_landing

from trafficlens.__main__ import IncompleteLoad, run_load
from trafficlens.params import ReportParams
from trafficlens.session import local_path
from trafficlens.sources.report_api import (current_pages, missing_requests, page_completeness, page_coverage,
                                            read_report_pages)
from trafficlens.sources.schemas import LOADED_BANNERS

DAY = "2024-01-03"
P = ReportParams.for_testdata().with_(load_default_start=DAY, load_today="2024-01-04")


def day_page(token, n, announced, first=None, **kw):
    """A page of ``n`` rows from offset ``first`` (the token, if it is a number) on."""
    at = int(token) if first is None else first
    return page(DAY, DAY, token, day_rows(3, 100)[at:at + n], announced, **kw)


def landed(spark, scratch, pages):
    path = scratch("landing")
    write_landing(local_path(path), pages)
    return read_report_pages(spark, path)


def status(spark, scratch, pages):
    return page_coverage(landed(spark, scratch, pages)).first()


def ranges(row):
    return [(r.first, r.stop) for r in row.missing]


def test_whole_window(spark, scratch):
    r = status(spark, scratch, [day_page("0", 4, 10), day_page("4", 4, 10), day_page("8", 2, 10)])
    assert (r.pages, r.superseded, r.expected_rows, r.landed_rows, r.covered_rows) == (3, 0, 10, 10, 10)
    assert r.complete and r.golden and r.overlap_rows == r.unplaced == 0 and ranges(r) == []


def test_a_page_landed_twice_does_not_hide_a_missing_one(spark, scratch):
    pages = [day_page("0", 4, 8), day_page("0", 4, 8)]
    r = status(spark, scratch, pages)
    assert (r.pages, r.superseded, r.covered_rows, r.complete) == (1, 1, 4, False)
    assert ranges(r) == [(4, 8)]
    assert not page_completeness(landed(spark, scratch, pages)).first().complete


def test_gaps_are_named(spark, scratch):
    r = status(spark, scratch, [day_page("2", 2, 20), day_page("6", 1, 20), day_page("7", 3, 20)])
    assert ranges(r) == [(0, 2), (4, 6), (10, 20)]
    assert (r.covered_rows, r.overlap_rows, r.complete) == (6, 0, False)


def test_overlaps_are_counted(spark, scratch):
    r = status(spark, scratch, [day_page("0", 5, 8), day_page("3", 2, 8), day_page("4", 4, 8)])
    assert (r.landed_rows, r.covered_rows, r.overlap_rows, r.complete, ranges(r)) == (11, 8, 3, False, [])
    beyond = status(spark, scratch, [day_page("0", 9, 8)])  # more rows than announced
    assert (beyond.covered_rows, beyond.overlap_rows, beyond.complete) == (8, 1, False)


def test_tokens(spark, scratch):
    first = status(spark, scratch, [day_page(None, 4, 6, first=0), day_page("4", 2, 6)])
    assert first.complete
    odd = status(spark, scratch, [day_page("0", 4, 6), day_page("next", 2, 6, first=4), day_page("-3", 0, 6, first=0)])
    assert (odd.unplaced, odd.complete, ranges(odd)) == (2, False, [(4, 6)])
    empty = status(spark, scratch, [page(DAY, DAY, "0", None, None)])
    assert empty.complete and (empty.expected_rows, empty.pages) == (0, 1)


def test_the_newest_landing_wins(spark, scratch):
    path = scratch("landing")
    write_landing(local_path(path), [day_page("0", 2, 4), day_page("2", 2, 4), day_page("0", 2, 4, sampled=True)])
    folder = os.path.join(local_path(path), f"startDate={DAY}")
    old, new = os.path.join(folder, "page-2.json"), os.path.join(folder, "page-0.json")
    os.utime(old, (1_700_000_000, 1_700_000_000))
    os.utime(new, (1_800_000_000, 1_800_000_000))
    pages = read_report_pages(spark, path)
    r = page_coverage(pages).first()
    assert (r.pages, r.superseded, r.complete, r.golden) == (2, 1, True, True)
    os.utime(old, (1_900_000_000, 1_900_000_000))
    assert page_coverage(read_report_pages(spark, path)).first().golden is False
    assert current_pages(pages).count() == 2


def test_requests_for_what_is_missing_complete_the_window(spark, scratch):
    rng = random.Random(4)
    whole = 37
    have = [day_page(str(a), min(5, whole - a), whole) for a in range(0, whole, 5) if rng.random() < 0.5]
    coverage = page_coverage(landed(spark, scratch, have))
    asked = [(r.pageToken, r.page_size) for r in missing_requests(coverage, 3).collect()]
    assert all(n <= 3 for _, n in asked)
    more = [day_page(t, n, whole) for t, n in asked]
    assert status(spark, scratch, have + more).complete
    anew = page_coverage(landed(spark, scratch, [day_page("0", 4, 6), day_page("3", 3, 6)]))
    assert [(r.pageToken, r.page_size) for r in missing_requests(anew, 4).collect()] == [("0", 4), ("4", 2)]


def test_load_takes_each_row_once_and_names_the_rows_that_lack(spark, scratch):
    landing, target = scratch("landing"), scratch("target")
    pages = [day_page("0", 2, 6), day_page("0", 2, 6), day_page("2", 2, 6), day_page("2", 2, 6)]
    write_landing(local_path(landing), pages)
    with pytest.raises(IncompleteLoad, match=r"\(4/6\) missing rows 4-5"):
        run_load(spark, landing, target, P)
    write_landing(local_path(landing), [*pages, day_page("4", 2, 6)])
    assert run_load(spark, landing, target, P)["loaded_rows"] == 6
    assert spark.read.schema(LOADED_BANNERS).parquet(target).count() == 6
