from __future__ import annotations

import zlib

import numpy as np

from trafficlens.llm import quality_classifier as qc
from trafficlens.llm.tables import read_table


def test_held_out_accuracy(spark):
    docs = read_table(spark, "/root/testdata/sf0.01", "documents", "doc_id", "text")
    labels = read_table(spark, "/root/testdata/sf0.01", "labels", "doc_id", "quality")
    rows = qc.quality_scores(docs, labels).join(labels, "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["predicted"] == r["quality"] for r in held) >= 0.96 * len(held)
    good = [r["score"] for r in held if r["quality"] == 1]
    bad = [r["score"] for r in held if r["quality"] == 0]
    assert np.mean([g > b for g in good for b in bad]) >= 0.98


def test_indicators_are_distinct_and_per_document():
    data = np.frombuffer(b"a b a b c c c" + b"a b a b c c c" + b"xy", np.uint8)
    doc, feature = qc.indicators(data, np.array([0, 13, 26, 26, 28]))
    rows = [feature[doc == d].tolist() for d in range(4)]
    assert rows[0] == rows[1] == sorted(set(rows[0])) and rows[2] == [] and len(rows[3]) == 1


def test_fit_separates_and_one_class_gives_half():
    rows = [(np.array([1, 2, 3]), 1), (np.array([2, 3]), 1), (np.array([7, 8]), 0), (np.array([8, 9]), 0)]
    model = qc.fit(rows)
    assert model.weight[2] > 0 > model.weight[8]
    assert qc.fit(rows[:2]).weight.max() == 0


def test_edge_rows(spark, make_docs):
    docs = make_docs([(1, None), (2, ""), (3, "good words here"), (4, "bad bad bad"), (4, "bad bad bad"),
                      (None, "good words"), (6, "w " * 200_000)])
    labels = spark.createDataFrame([(3, 1, "x"), (4, 0, "x"), (None, 1, "x"), (2, None, "x"), (3, 1, "y"), (77, 1, "z")],
                                   "doc_id long, quality int, text string")
    rows = qc.quality_scores(docs, labels).collect()
    assert len(rows) == 7 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    assert qc.quality_scores(docs.limit(0), labels).collect() == []
    assert {r["score"] for r in qc.quality_scores(docs, labels.limit(0)).collect()} == {0.5}


def test_many_rows_of_one_id_are_one_document(spark, make_docs):
    docs = make_docs([(1, "bad bad")] * 20_000 + [(i, f"good words {i}") for i in range(2, 20)]).select("doc_id", "text")
    labels = spark.createDataFrame([(1, 0)] + [(i, 1) for i in range(2, 20)], "doc_id long, quality int")
    sample = qc.training_sample(docs, labels, 5)
    assert sorted(y for _, y in sample) == [0, 1, 1, 1, 1, 1]


def test_the_dual_is_solved_and_scores_follow_from_it():
    """Primal value of the fitted model against the dual optimum of a plain solver; scores text by text."""
    import pyarrow as pa
    rng = np.random.default_rng(5)
    rows = [(np.unique(rng.integers(0, 40, 8) + 15 * y), int(y)) for y in rng.integers(0, 2, 40)]
    cost = 1.0
    model = qc.fit(rows, blend=1.0, cost=cost, epochs=500)
    y = np.array([1.0 if label else -1.0 for _, label in rows])
    v = np.zeros((len(rows), 60))
    for i, (f, _) in enumerate(rows):
        v[i, f] = model.ratio[f] / np.sqrt(np.dot(model.ratio[f], model.ratio[f]))
    some = model.ratio[:60] != 0
    w = np.where(some, model.weight[:60] / np.where(some, model.ratio[:60], 1), 0)
    primal = 0.5 * (w @ w + model.bias ** 2) + cost * np.maximum(0, 1 - y * (v @ w + model.bias)).sum()
    q = (v @ v.T + 1) * np.outer(y, y)
    alpha = np.zeros(len(rows))
    for _ in range(20_000):  # projected gradient ascent
        alpha = np.clip(alpha + (1 - q @ alpha) / np.linalg.norm(q, 2), 0, cost)
    dual = alpha.sum() - 0.5 * alpha @ q @ alpha
    assert -1e-6 <= primal - dual <= 1e-2 * dual

    texts = ["good words here", "", "bad bad bad", "a b c d e f g " * 50]
    whole = qc.fit([(qc.indicators(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)]))[1], k % 2)
                    for k, t in enumerate(texts) if t])
    whole = qc.fit([(np.array([1, 2, 3]), 1), (np.array([8, 9]), 0)]) if whole.weight.max() == 0 else whole
    scores = qc.score_column(whole, pa.array(texts, pa.large_string()))
    for t, got in zip(texts, scores, strict=True):
        f = qc.indicators(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))[1] if t else []
        margin = sum(whole.weight[k] for k in f) / max(np.sqrt(sum(whole.ratio[k] ** 2 for k in f)), 1e-12) + whole.bias
        assert abs(got - 1 / (1 + np.exp(-whole.scale * margin))) < 1e-9
