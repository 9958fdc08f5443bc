from __future__ import annotations

import random

import pyarrow as pa
from brute import WORD

from trafficlens.llm import packing as pk


def test_word_facts():
    rng = random.Random(2)
    texts = ["".join(rng.choice(" \t\n\x0b\x0c\ré漢ab \x1c") for _ in range(rng.randrange(60))) for _ in range(2000)]
    texts += ["", None, "   ", "a" + " " * 5000 + "b", "a b", "\na\t\tb "]
    got = pk.word_facts(pa.array(texts)).to_pylist()
    words = [WORD.findall(t or "") for t in texts]
    assert [r["words"] for r in got] == [len(w) for w in words]
    digests = {}
    for w, r in zip(words, got, strict=True):
        assert digests.setdefault(tuple(w), r["same"]) == r["same"]
    assert len(set(digests.values())) == len(digests)


def test_word_facts_fold_case():
    """Digests of texts are equal where their lower-cased words are, beyond A-Z too."""
    got = pk.word_facts(pa.array(["\u00c9T\u00c9 Ab", "\u00e9t\u00e9  aB", "ete ab", "A\tB", "a b", "\u0130x"])).to_pylist()
    assert [r["words"] for r in got] == [2, 2, 2, 2, 2, 1]
    same = [r["same"] for r in got]
    assert same[0] == same[1] and same[3] == same[4] and len(set(same)) == 4


def best_fit(items, capacity):
    """Reference: for each item scan all bins for the tightest compatible one."""
    bins, out = [], []
    for n, source, cluster in items:
        fits = [(b["left"], k) for k, b in enumerate(bins) if b["left"] >= n and not b["s"] & source
                and not b["c"] & cluster and b["left"] > 0]
        k = min(fits)[1] if fits else len(bins)
        if not fits:
            bins.append({"left": capacity, "s": 0, "c": 0})
        out.append((k, capacity - bins[k]["left"]))
        bins[k]["left"] -= n
        bins[k]["s"] |= source
        bins[k]["c"] |= cluster
    return out


def test_placement_equals_an_exhaustive_search():
    rng = random.Random(2)
    for _ in range(20):
        items = sorted(((rng.randrange(1, 50), 1 << rng.randrange(6) if rng.random() < 0.8 else 0,
                         1 << rng.randrange(30)) for _ in range(200)), reverse=True)
        bins = pk.Bins(64)
        assert [bins.place(*i) for i in items] == best_fit(items, 64)


def test_bins_hold_the_constraints(make_docs):
    rng = random.Random(8)
    rows = [(i, " ".join(["w%d" % rng.randrange(9)] * rng.choice([0, 1, 5, 30, 64, 65, 200])), None,
             rng.choice(["hot", "hot", "a", "b", "c", None])) for i in range(400)]
    got = pk.best_fit_packing(make_docs(rows), capacity=64, shard_items=100).collect()
    words, bins = {}, {}
    for r in got:
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + r["n_words"]
        if r["bin_id"] is not None:
            bins.setdefault(r["bin_id"], []).append(r)
    assert words == {i: len(WORD.findall(t)) for i, t, *_ in rows}
    text, source = {r[0]: r[1] for r in rows}, {r[0]: r[3] for r in rows}
    for held in bins.values():
        held.sort(key=lambda r: r["bin_start"])
        assert all(a["bin_start"] + a["n_words"] <= b["bin_start"] for a, b in zip(held, held[1:], strict=False))
        assert held[-1]["bin_start"] + held[-1]["n_words"] <= 64
        named = [source[r["doc_id"]] for r in held if source[r["doc_id"]] is not None]
        assert len(named) == len(set(named))
        assert len({text[r["doc_id"]] for r in held}) == len(held)


def test_edge_rows(make_docs):
    docs = make_docs([(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "c"), (5, "x " * 100_000, None, "s")])
    got = pk.best_fit_packing(docs).collect()
    assert sum(r["n_words"] for r in got) == 2 + 2 + 1 + 100_000
    assert [r["bin_id"] for r in got if r["doc_id"] in (1, 2)] == [None, None]
    assert len({r["bin_id"] for r in got if r["doc_id"] == 3}) == 2  # copies never share a bin
    assert pk.best_fit_packing(docs.limit(0)).collect() == []
    again = pk.best_fit_packing(docs).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_named_cluster_column(make_docs):
    from pyspark.sql import functions as F
    docs = make_docs([(i, f"w{i}") for i in range(6)]).withColumn("group", F.lit("one"))
    assert len({r["bin_id"] for r in pk.best_fit_packing(docs, cluster="group").collect()}) == 6
    assert len({r["bin_id"] for r in pk.best_fit_packing(docs).collect()}) == 1


def near_rows():
    """Groups of near copies of different sources, some without id, some equal but for the case of a letter."""
    rng = random.Random(5)
    rows = []
    for i in range(60):
        base = [f"b{i}x{rng.randrange(1000)}" for _ in range(30)]
        rows += [(3 * i, " ".join(base), None, f"s{i}"), (3 * i + 1, " ".join(base) + " end", None, f"t{i}"),
                 (None if i % 2 else 3 * i + 2, " ".join(["start", *base]), None, None)]
    return rows + [(900, "\u00c9t\u00e9", None, "a"), (901, "\u00e9t\u00e9", None, "b")]


def test_near_copies_of_different_sources_share_no_bin(make_docs):
    rows = near_rows()
    docs = make_docs(rows)
    got = pk.near_copy_packing(docs, capacity=4096).collect()
    assert len(got) == len(rows)
    assert sum(r["n_words"] for r in got) == sum(len(WORD.findall(t)) for _, t, *_ in rows)
    bins = {r["doc_id"]: r["bin_id"] for r in got if r["doc_id"] is not None}
    for i in range(60):
        ids = [k for k in (3 * i, 3 * i + 1, 3 * i + 2) if k in bins]
        assert len({bins[k] for k in ids}) == len(ids)
    assert bins[900] != bins[901]
    assert len({r["bin_id"] for r in got}) == 3
    assert len({r["bin_id"] for r in pk.best_fit_packing(docs, capacity=8192).collect()}) < 3
    assert pk.near_copy_packing(docs.limit(0)).collect() == []


def test_op7_takes_near_copies_as_clusters(spark):
    from brute import jaccard_components

    from trafficlens.llm import queries
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    near = {i: c for i, (_, c) in jaccard_components([tuple(r) for r in docs]).items()}
    placed = [(r["bin_id"], near[r["doc_id"]], r["doc_id"]) for r in queries.op7_best_fit_packing(spark, sf).collect()
              if r["bin_id"] is not None]
    assert len({(b, c) for b, c, _ in placed}) == len({(b, i) for b, _, i in placed}) == len(placed)
