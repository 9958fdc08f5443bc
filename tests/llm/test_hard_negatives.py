from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from trafficlens.llm import hard_negatives as hn


def brute(rows, every=hn.ANCHOR_EVERY, positives=hn.POSITIVES, negatives=hn.NEGATIVES):
    """Every anchor against every row, in Python integers; rows of (vec_id, label, embedding)."""
    taken = set()
    for i, y, v in rows:
        if i is None or y is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        taken.add((i, (y + 1) % 10 if i % 7 == 0 else y, tuple(math.floor(256 * x) for x in v)))
    out = []
    for a in taken:
        if a[0] % every:
            continue
        long = lambda x: max(-2 ** 63, min(2 ** 63 - 1, x))
        scored = sorted(((long(sum(x * y for x, y in zip(a[2], b[2], strict=True))), b) for b in taken if len(b[2]) == len(a[2])),
                        key=lambda s: (-s[0], s[1][0]))
        for ps, p in [s for s in scored if s[1][1] == a[1] and s[1] != a][:positives]:
            found = [s for s in scored if s[1][1] != a[1] and 30 * ps <= 100 * s[0] <= 90 * ps][:negatives]
            out += [(a[0], p[0], k + 1, n[0], ps, ns) for k, (ns, n) in enumerate(found)]
    return sorted(out)


def run(spark, rows, parts=3, kind="double", **kw):
    df = spark.createDataFrame(rows, f"vec_id long, label int, embedding array<{kind}>").repartition(parts)
    df = df.withColumn("rank", F.lit("x")).withColumn("key", F.lit(1)).withColumn("id", F.lit(2)).withColumn("positives", F.lit(3))
    return sorted(tuple(r) for r in hn.hard_negatives(df, **kw).collect())


def clustered(n, dim, seed, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, dim))
    return [(i, int(i % labels), (centres[i % labels] * 0.2 + rng.normal(size=dim) * 0.1).tolist()) for i in range(n)]


def test_clusters_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(hn, "LEAST_ROWS", 64)  # several chunks
    rows = clustered(700, 19, 1)
    assert run(spark, rows, anchor_every=10) == brute(rows, 10)


def test_ties_copies_and_short_windows(spark):
    rows = [(i, i % 3, [1.0, 0.5]) for i in range(90)] + [(i, 1, [0.5, 0.25 * (i % 3)]) for i in range(90, 130)]
    rows += rows[:50]  # repeated rows are one row
    got = run(spark, rows, anchor_every=15)
    assert got == brute(rows, 15)
    assert got


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [1.0, 2.0]), (1, 1, [1.0, 2.0]), (2, 2, [0.5, 1.0]), (3, 2, [nan, 1.0]), (4, 2, [inf, 1.0]),
            (5, 2, [None, 1.0]), (6, 2, None), (None, 2, [1.0, 1.0]), (8, None, [1.0, 1.0]), (9, 2, [1.0]), (10, 2, []),
            (100, 1, []), (101, 1, []), (102, 2, []), (200, 1, [-1.0, 0.0]), (300, 5, [0.0, 0.0]), (301, 5, [0.0, 0.0])]
    got = run(spark, rows)
    assert got == brute(rows)
    assert (100, 101, 1, 10, 0, 0) in got  # scores of 0 admit 0
    assert run(spark, []) == []
    assert run(spark, [(1, 1, [1.0]), (2, 2, [1.0])]) == []  # no anchors


def test_repeated_ids_are_rows_of_their_own(spark):
    rows = [(0, 3, [1.0, 0.0]), (0, 3, [0.9, 0.1]), (0, 4, [0.6, 0.0]), (1, 3, [0.8, 0.0]), (2, 4, [0.5, 0.5])]
    assert run(spark, rows) == brute(rows)


def test_products_beyond_floats(spark):
    rows = [(0, 4, [3e6, 1.0]), (1, 5, [2e6, 5.0]), (2, 6, [1e6, 3.0]), (3, 6, [9e5, 3.0]), (100, 5, [2e6, 5.0])]
    got = run(spark, rows)
    assert got == brute(rows) and max(r[4] for r in got) > 2 ** 53
    huge = [(i, y, [x * 1e6 for x in v]) for i, y, v in rows]
    assert run(spark, huge) == brute(huge)


def test_index_omits_and_prunes():
    """High thresholds touch a fraction of the postings; no row over the threshold is lost."""
    rng = np.random.default_rng(3)
    scale = 0.5 ** np.arange(64)
    rows = np.floor(256 * rng.normal(size=(5000, 64)) * scale).astype(np.int64)
    index = hn.Index(np.arange(5000), np.arange(5000), np.zeros(5000, np.int64), rows)
    anchors = rows[:20]
    scores = anchors @ rows.T
    least = np.sort(scores, axis=1)[:, -10].astype(np.float64)
    for a, found, values in index.search(anchors, least):
        want = np.flatnonzero(scores[a] >= least[a])
        assert sorted(found.tolist()) == want.tolist()
        assert (np.sort(values) == np.sort(scores[a][want])).all()
    assert index.multiplied < 0.3 * index.possible


def test_whole_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r["vec_id"], r["label"], r["embedding"]) for r in table.collect()]
    assert run(spark, rows, 5, "float") == brute(rows)
