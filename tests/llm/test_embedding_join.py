from __future__ import annotations

import numpy as np
import pytest
from brute import Forest

from trafficlens.llm import embedding_join as ej

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string, cid int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "mine", 1) for i, v in rows], SCHEMA)


def brute(rows, threshold=0.95):
    ok = {i: np.array(v, float) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    forest, links = Forest([i for i, _ in rows]), {i: 0 for i, _ in rows}
    for i, a in ok.items():
        for j, b in ok.items():
            if i != j and len(a) == len(b) and a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= threshold:
                links[i] += 1
                forest.join(i, j)
    return {i: (links[i], forest.root(i), forest.root(i) == i) for i, _ in rows}


def found(df):
    return {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in df.collect()}


def clustered(n, seed, dims=8):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(12, dims))
    rows = []
    for i in range(n):
        v = centers[rng.integers(12)] * rng.uniform(0.5, 3) + rng.normal(size=dims) * rng.choice([0.0, 0.1, 0.4])
        rows.append((i * 2 + 5, v.astype(np.float32).tolist()))
    return rows


@pytest.mark.parametrize("chunk,pivots", [(2048, 256), (16, 7), (5, 40)])
def test_links_equal_brute_force(spark, monkeypatch, chunk, pivots):
    monkeypatch.setattr(ej, "CHUNK", chunk)
    monkeypatch.setattr(ej, "MAX_PIVOTS", pivots)
    rows = clustered(400, chunk)
    assert found(ej.embedding_join(frame(spark, rows))) == brute(rows)


def test_edge_rows(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, []), (6, [1.0, None]),
            (7, [float("nan"), 1.0]), (8, [float("inf"), 1.0]), (9, [1.0, 0.0, 0.0]), (10, [1.0, 0.0]),
            (11, [0.0, 1e-30]), (12, [0.0, 1e30])]
    assert found(ej.embedding_join(frame(spark, rows))) == brute(rows)
    assert found(ej.embedding_join(frame(spark, rows).limit(0))) == {}
    twice = ej.embedding_join(frame(spark, [(1, [1.0]), (1, [1.0]), (None, [1.0])])).collect()
    assert sorted((r["vec_id"] or 0, r["n_links"], r["kept"]) for r in twice) == [(0, 0, False), (1, 1, True),
                                                                                 (1, 1, True)]


def test_copies_are_counted(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(300)] + [(900, [3.0, -1.0, 0.0])]
    got = found(ej.embedding_join(frame(spark, rows)))
    assert got[0] == (299, 0, True) and got[299] == (299, 0, False) and got[900] == (0, 900, True)


def test_rows_that_share_an_id_are_one_node(spark):
    x, y = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    rows = [(3, x), (4, y), (5, x), (5, y), (6, [0.0, 0.0, 1.0]), (6, None)]
    got = sorted((r["vec_id"], r["component_id"], r["n_links"]) for r in ej.embedding_join(frame(spark, rows)).collect())
    assert got == [(3, 3, 1), (4, 3, 1), (5, 3, 1), (5, 3, 1), (6, 6, 0), (6, 6, 0)]
