"""Quality classifier: naive Bayes support vectors.

N-gram indicators (words, word pairs, three-byte runs) of the whole text are
scaled by the class log-count ratios, each document to unit length, and a
linear hinge-loss model is fitted by dual coordinate descent. The fit runs on
a bounded sample of labelled rows (``sample_per_class``); scoring is one
vectorised pass over every row, with the model broadcast (12 bytes per bucket).

Defined cases: a null or empty text has no indicators and scores the model's
bias; a null ``doc_id`` is never trained on (its held-out flag is null); a
``doc_id`` labelled twice counts with the mean of its labels, one with several
rows of text once; without labels of
both classes every score is 0.5; repeated rows get equal scores. Only
``doc_id`` and ``text`` are read from the documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficlens.llm import textops as tx
from trafficlens.llm.tables import ship_package

BUCKET_BITS = 18
BUCKETS = 1 << BUCKET_BITS
FEATURES = 3 * BUCKETS
_SHIFT = np.uint64(64 - BUCKET_BITS)
RUNS = (2, 3, 4, 6, 8)  # n-grams of one word repeated: a feature for each n, whatever the word is


class Model(NamedTuple):
    ratio: np.ndarray    # log-count ratio of each feature
    weight: np.ndarray   # ratio times fitted weight
    bias: float
    scale: float         # of the logistic curve


def indicators(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of each document: ``(document, feature)`` pairs, sorted.

    One word repeated n times is a feature of its own for each n of ``RUNS``."""
    starts, ends, word_offsets = tx.word_spans(data, offsets)
    words = tx.span_hashes(data, starts, ends)
    doc_of_word = np.repeat(np.arange(len(offsets) - 1), np.diff(word_offsets))
    keys = [(doc_of_word * FEATURES).astype(np.uint64) + (words >> _SHIFT)]
    inner = doc_of_word[1:] == doc_of_word[:-1]
    left, right = words[:-1][inner], words[1:][inner]
    keys.append((doc_of_word[1:][inner] * FEATURES + BUCKETS).astype(np.uint64)
                + (tx.mix64(left * np.uint64(3) + right) >> _SHIFT))
    same = inner & (words[1:] == words[:-1])
    for k, n in enumerate(RUNS):
        run = same.copy()
        for shift in range(1, n - 1):
            left = max(len(run) - shift, 0)
            run[:left] &= same[shift:shift + left]
            run[left:] = False
        keys.append((doc_of_word[1:][run] * FEATURES + BUCKETS).astype(np.uint64) + np.uint64(k))
    if len(data) >= 3:
        run = data[:-2].astype(np.uint64) << np.uint64(16) | data[1:-1].astype(np.uint64) << np.uint64(8) | data[2:]
        doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        whole = doc[:-2] == doc[2:]
        keys.append((doc[:-2][whole] * FEATURES + 2 * BUCKETS).astype(np.uint64)
                    + ((run[whole] * np.uint64(0x9E3779B97F4A7C15)) >> _SHIFT))
    flat = np.sort(np.concatenate(keys))
    if len(flat):
        flat = flat[np.concatenate(([True], flat[1:] != flat[:-1]))]
    return (flat // np.uint64(FEATURES)).astype(np.int64), (flat % np.uint64(FEATURES)).astype(np.int64)


def fit(rows: list[tuple[np.ndarray, int]], smoothing: float = 1.0, blend: float = 0.5, cost: float = 1.0,
        epochs: int = 20, seed: int = 7) -> Model:
    """Log-count ratios and dual coordinate descent over ``(features, label)`` rows."""
    labels = np.array([y for _, y in rows], dtype=np.int64)
    if len(rows) == 0 or labels.min() == labels.max():
        return Model(np.zeros(FEATURES), np.zeros(FEATURES), 0.0, 1.0)
    counts = [np.full(FEATURES, smoothing) for _ in (0, 1)]
    for features, y in rows:
        counts[y][features] += 1.0
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    values = []
    for features, _ in rows:
        v = ratio[features]
        values.append(v / max(np.sqrt(np.dot(v, v)), 1e-12))
    sign = np.where(labels == 1, 1.0, -1.0)
    weight, bias, alpha = np.zeros(FEATURES), 0.0, np.zeros(len(rows))
    order = np.arange(len(rows))
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        rng.shuffle(order)
        moved = 0.0
        for i in order:
            features, v = rows[i][0], values[i]
            gradient = sign[i] * (np.dot(weight[features], v) + bias) - 1.0
            step = min(max(alpha[i] - gradient / (np.dot(v, v) + 1.0), 0.0), cost) - alpha[i]
            if step:
                alpha[i] += step
                weight[features] += step * sign[i] * v
                bias += step * sign[i]
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    weight = (1 - blend) * np.abs(weight).mean() + blend * weight
    return Model(ratio, ratio * weight, blend * bias, 4.0)


def margins(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    n = len(offsets) - 1
    doc, feature = indicators(data, offsets)
    ratio = model.ratio[feature]
    norm = np.sqrt(np.bincount(doc, ratio * ratio, minlength=n))
    return np.bincount(doc, model.weight[feature], minlength=n) / np.maximum(norm, 1e-12) + model.bias


def score_column(model: Model, column: pa.Array) -> np.ndarray:
    """Scores (0 to 1) of a text column."""
    out = np.zeros(len(column))
    for first, last, data, offsets in tx.text_chunks(column):
        out[first:last] = 1.0 / (1.0 + np.exp(-np.clip(model.scale * margins(model, data, offsets), -50, 50)))
    return out


def training_sample(docs: DataFrame, labels: DataFrame, sample_per_class: int) -> list[tuple[np.ndarray, int]]:
    """Features of at most ``sample_per_class`` labelled documents of each class
    (the ids with the smallest hashes; of an id with several rows the least text)."""
    labelled = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
                .groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("label")))
    ids = None
    for y in (0, 1):
        one = (labelled.where(F.col("label") == y).orderBy(F.xxhash64("doc_id"), "doc_id")
               .limit(sample_per_class))
        ids = one if ids is None else ids.unionAll(one)
    chosen = (docs.join(F.broadcast(ids), "doc_id")  # at most two samples of ids
              .groupBy("doc_id", "label").agg(F.min("text").alias("text")))

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in tx.text_chunks(batch.column("text")):
                doc, feature = indicators(data, offsets)
                ends = np.searchsorted(doc, np.arange(last - first + 1))
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column("doc_id").slice(first, last - first),
                    "label": batch.column("label").slice(first, last - first),
                    "features": pa.array([feature[a:b].astype(np.int32).tobytes()
                                          for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary()),
                })

    found = chosen.mapInArrow(featurise, f"doc_id {dict(docs.dtypes)['doc_id']}, label int, features binary").collect()
    found.sort(key=lambda r: (r["doc_id"], r["label"], bytes(r["features"])))
    return [(np.frombuffer(bytes(r["features"]), np.int32).astype(np.int64), r["label"]) for r in found]


def quality_scores(docs: DataFrame, labels: DataFrame, sample_per_class: int = 3000) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` for every document.

    Rows whose ``crc32(doc_id as text) mod 3`` is 1 are held out of the fit."""
    ship_package(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    model = fit(training_sample(docs, labels.where(~held_out), sample_per_class))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            yield pa.array(score_column(shared.value, column))

    return (docs.select("doc_id", held_out.alias("held_out"), score("text").alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))
