from __future__ import annotations

import numpy as np
import pytest
from brute import Forest

from trafficlens.llm import components as co
from trafficlens.llm.tables import Scratch


def brute(links):
    forest = Forest({i for link in links for i in link})
    for a, b in links:
        forest.join(a, b)
    return {i: forest.root(i) for link in links if link[0] != link[1] for i in link}


def graph(kind):
    rng = np.random.default_rng(1)
    if kind == "path":
        return [(i, i + 1) for i in range(300)]
    if kind == "star":
        return [(500, i) for i in range(300)] + [(500, 900)]
    if kind == "random":
        return [tuple(map(int, p)) for p in rng.integers(0, 400, (260, 2))]
    if kind == "rings":
        return [(100 * r + i, 100 * r + (i + 1) % 40) for r in range(5) for i in range(40)] + [(-7, 3)]
    return []


@pytest.mark.parametrize("held", [1 << 20, 7])
@pytest.mark.parametrize("kind", ["path", "star", "random", "rings", "empty"])
def test_equal_a_union_of_all_links(spark, monkeypatch, kind, held):
    monkeypatch.setattr(co, "HELD", held)  # with few links a task its forest goes in pieces
    links = graph(kind)
    df = spark.createDataFrame([*links, (5, 5), (None, 4), (4, None)], "a long, b long").repartition(9)
    got = co.components(df, Scratch(spark, "t")).collect()
    assert len(got) == len({r["id"] for r in got})
    assert {r["id"]: r["component"] for r in got} == {i: c for i, c in brute(links).items()}


def test_spanning_forest_keeps_connectivity():
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 60, (2, 40))
    u, v = co.spanning_forest(a, b)
    assert (u > v).all() and len(set(u.tolist())) == len(u)
    want = brute([(int(x), int(y)) for x, y in zip(a, b, strict=True)])
    assert dict(zip(u.tolist(), v.tolist(), strict=True)) == {i: c for i, c in want.items() if i != c}


def test_few_links_take_few_jobs(spark):
    """Links that fit a task are contracted in one, whatever their number of partitions."""
    df = spark.createDataFrame(graph("path"), "a long, b long").repartition(9)
    spark.sparkContext.setJobGroup("few-links", "components")
    got = co.components(df, Scratch(spark, "t")).collect()
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("few-links"))
    spark.sparkContext.setJobGroup("other", "other")
    assert {r["component"] for r in got} == {0} and len(got) == 301
    assert jobs <= 6


@pytest.mark.parametrize("links", [[], [(9, 4), (4, 9), (7, 4), (3, 8)]])
def test_links_ended_in_one_task(spark, links):
    df = spark.createDataFrame(links, "a long, b long").repartition(3)
    got = {r["id"]: r["component"] for r in co.ended(df).collect()}
    assert got == brute(links)
