from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from brute import jaccard_components

from trafficlens.llm import ngram_join as nj


def found(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def copies(seed, n, words=60, edits=4, vocabulary=400):
    """Near copies of a few base texts, with unrelated texts that share passages."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(vocabulary)}"
    bases = [[word() for _ in range(words)] for _ in range(4)]
    passage = [word() for _ in range(20)]
    rows = []
    for i in range(n):
        text = list(rng.choice(bases)) if rng.random() < 0.7 else [word() for _ in range(rng.randrange(1, 80))]
        for _ in range(rng.randrange(edits)):
            text[rng.randrange(len(text))] = word()
        if rng.random() < 0.4:
            text += passage
        rows.append((i * 3 + 1, " ".join(text)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(make_docs, seed):
    rows = copies(seed, 160)
    assert found(nj.ngram_join(make_docs(rows))) == jaccard_components(rows)


@pytest.mark.parametrize("small", [2, 6])
def test_columns_of_many_blocks_equal_brute_force(make_docs, monkeypatch, small):
    monkeypatch.setattr(nj, "SMALL_COLUMN", small)
    monkeypatch.setattr(nj, "COLUMN_BLOCK", 4)
    monkeypatch.setattr(nj, "BLOCK", 3)
    rows = copies(3, 120, edits=9)
    assert found(nj.ngram_join(make_docs(rows))) == jaccard_components(rows)


@pytest.mark.parametrize("held", [1 << 20, 16])
def test_shared_columns(spark, monkeypatch, held):
    """Entries of columns with several documents, one leader a column: the smallest
    set, where the column's bucket is held whole."""
    monkeypatch.setattr(nj, "HELD_ENTRIES", held)
    rng = np.random.default_rng(4)
    kinds = rng.integers(0, 2**64, 150, dtype=np.uint64)
    rows, columns = [], {}
    for i in range(120):
        grams = rng.choice(kinds, rng.integers(1, 12), replace=False)
        if i % 2:
            grams = np.union1d(grams, kinds[:1])  # one large column
        rows.append((i * 7 % 121, int(rng.integers(1, 9)), bytearray(grams.tobytes())))
        for g in grams.view(np.int64).tolist():
            columns.setdefault(g, []).append((rows[-1][1], rows[-1][0]))
    reps = spark.createDataFrame(rows, "doc_id long, n long, prefix binary").repartition(5)
    for bits in (1, 6):
        got, leaders = {}, {}
        for r in nj.shared_columns(reps, bits).collect():
            got.setdefault(r["gram"], []).append((r["n"], r["doc_id"]))
            leaders.setdefault(r["gram"], set()).add((r["leader_n"], r["leader"]))
        several = {g: sorted(c) for g, c in columns.items() if len(c) > 1}
        assert {g: sorted(c) for g, c in got.items()} == several
        assert all(len(x) == 1 and x <= set(several[g]) for g, x in leaders.items())
        if held > 16:
            assert all(x == {several[g][0]} for g, x in leaders.items())


@pytest.mark.parametrize("held", [3, 40])
def test_buckets_in_pieces_equal_brute_force(make_docs, monkeypatch, held):
    monkeypatch.setattr(nj, "HELD_ENTRIES", held)
    monkeypatch.setattr(nj, "BUCKET_ENTRIES", 50)
    rows = copies(6, 150)
    assert found(nj.ngram_join(make_docs(rows))) == jaccard_components(rows)


def test_edge_rows(make_docs):
    long = " ".join(f"t{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE\ttwo"), (6, "one two three"), (7, "a b c d e"),
            (8, "A B C D E"), (9, long), (10, long + " end"), (11, "x y z q r"), (11, "x y z q r"), (None, "a b c d e")]
    got = nj.ngram_join(make_docs(rows)).collect()
    assert len(got) == len(rows)
    by = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got}
    assert by == {(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (6, 1, 6), (7, 1, 7), (8, 1, 7),
                  (9, 29_996, 9), (10, 29_997, 9), (11, 1, 11), (None, 1, None)}


def test_empty_table(make_docs):
    assert nj.ngram_join(make_docs([(1, "x")]).limit(0)).collect() == []


def test_threshold_is_exact(make_docs):
    # 16 shared shingles of 20 (0.8) link, 15 of 19 do not.
    a = [f"a{i}" for i in range(22)]
    rows = [(1, " ".join(a)), (2, " ".join(a[:20] + ["x", "y"])), (3, " ".join(["q"] * 5))]
    assert found(nj.ngram_join(make_docs(rows))) == jaccard_components(rows)


def test_bitmap_bounds_the_overlap_from_above():
    rng = np.random.default_rng(5)
    for n, m in ((60, 70), (500, 600), (3000, 3500)):
        x = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        y = np.unique(np.concatenate([x[:n // 2], rng.integers(0, 2**63, m - n // 2, dtype=np.uint64)]))
        a, b = (pa.array([nj.signature(s)], pa.binary()) for s in (x, y))
        bits = min(len(a[0].as_py()), len(b[0].as_py())) * 8
        left, right = nj._folded(a, bits), nj._folded(b, bits)
        only = int(np.bitwise_count(left & ~right).sum())
        assert len(x) - only >= len(np.intersect1d(x, y))


def test_rows_that_share_an_id_are_one_node(spark, make_docs):
    a, b = (" ".join(f"{c}{i}" for i in range(30)) for c in "ab")
    rows = [(3, a), (4, b), (5, a), (5, b), (6, "alone"), (6, None)]
    got = sorted((r["doc_id"], r["component_id"]) for r in nj.ngram_join(make_docs(rows)).collect())
    assert got == [(3, 3), (4, 3), (5, 3), (5, 3), (6, 6), (6, 6)]


def test_few_jobs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    spark.sparkContext.setJobGroup("ngram-jobs", "ngram join")
    nj.ngram_join(docs).count()
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("ngram-jobs"))
    spark.sparkContext.setJobGroup("other", "other")
    assert jobs <= 90
