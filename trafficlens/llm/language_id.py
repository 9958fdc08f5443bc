"""Language ID: string kernels with Nystrom landmarks and ridge regression.

The kernel of two texts is the number of distinct byte n-grams (two to four
bytes of the lower-cased text, blended) that both hold, over the square root of
the product of their own counts; its n-grams are those of the landmark texts.
Landmarks and fitting rows are bounded samples per language
(``landmarks_per_lang``, ``rows_per_lang``) of at most ``max_langs`` languages. One-versus-rest kernel ridge
regression gives every landmark a weight per language; as the kernel is linear
in the presence vectors, landmarks times weights fold into one matrix of n-gram
by language, and a batch of documents is scored by one matrix product.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
with no learnable row every text is ``und``; ties go to the first language in
order; a null ``doc_id`` is never learned from (its held-out flag is null); rows
that share an id and a language count as one document when learning. Only
``doc_id``, ``text`` and ``lang`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trafficlens.llm import textops as tx
from trafficlens.llm.tables import ship_package

UNDETERMINED = "und"
ORDERS = (2, 3, 4)
SLOT_BITS = 20
_SHIFT = np.uint32(32 - SLOT_BITS)


class Model(NamedTuple):
    langs: list[str]
    column: np.ndarray   # slot -> presence column, the last column where no landmark has the n-gram
    weights: np.ndarray  # presence column by language


def slots(data: np.ndarray, order: int) -> np.ndarray:
    """Slot of the n-gram that starts at each byte."""
    code = np.zeros(len(data) - order + 1, np.uint32)
    for k in range(order):
        code = code << np.uint32(8) | data[k:len(data) - order + 1 + k]
    return (code * np.uint32(2654435761) + np.uint32(order)) * np.uint32(2246822519) >> _SHIFT


def presence(data: np.ndarray, offsets: np.ndarray, column: np.ndarray, width: int) -> np.ndarray:
    """Documents by presence columns (bool); the last column collects unknown n-grams."""
    n = len(offsets) - 1
    out = np.zeros(n * width, dtype=bool)
    base = np.repeat(np.arange(n, dtype=np.int64) * width, np.diff(offsets))
    for order in ORDERS:
        if len(data) < order:
            continue
        inside = base[:len(data) - order + 1] == base[order - 1:]
        out[base[:len(data) - order + 1][inside] + column[slots(data, order)[inside]]] = True
    return out.reshape(n, width)


def lowered(texts: pa.Array) -> pa.Array:
    return pc.utf8_lower(texts.fill_null("") if texts.null_count else texts)


def all_presence(texts: list[str], column: np.ndarray, width: int) -> np.ndarray:
    parts = [presence(data, offsets, column, width)
             for _, _, data, offsets in tx.text_chunks(lowered(pa.array(texts, pa.large_string())))]
    return np.concatenate(parts) if parts else np.zeros((0, width), bool)


def fit(rows: list[tuple[str, str, int]], landmarks_per_lang: int, ridge: float = 1e-3) -> Model:
    """``rows``: (language, text, rank within the language)."""
    langs = sorted({lang for lang, _, _ in rows})
    marks = [text for _, text, rank in rows if rank <= landmarks_per_lang]
    column = np.zeros(1 << SLOT_BITS, np.int64)
    for _, _, data, offsets in tx.text_chunks(lowered(pa.array(marks, pa.large_string()))):
        for order in ORDERS:
            if len(data) >= order:
                column[slots(data, order)] = 1
    width = int(column.sum()) + 1
    column = np.where(column > 0, np.cumsum(column) - 1, width - 1)
    if not langs:
        return Model([], column, np.zeros((width, 0), np.float32))

    def unit(p: np.ndarray) -> np.ndarray:
        p = p[:, :-1].astype(np.float32)
        return p / np.maximum(np.sqrt(p.sum(axis=1, keepdims=True)), 1.0)

    anchor = unit(all_presence(marks, column, width))
    texts, names = [t for _, t, _ in rows], np.array([lang for lang, _, _ in rows])
    blocks = [unit(all_presence(texts[i:i + 256], column, width)) @ anchor.T for i in range(0, len(texts), 256)]
    across = np.concatenate(blocks).astype(np.float64)
    among = (anchor @ anchor.T).astype(np.float64)
    goal = np.where(names[:, None] == np.array(langs)[None, :], 1.0, -1.0)
    weight = np.maximum(1.0 / np.array([(names == lang).sum() for lang in langs]), 1e-9)
    of_row = weight[np.searchsorted(langs, names)][:, None]  # every language weighs the same
    system = across.T @ (across * of_row) + ridge * among + 1e-8 * np.eye(len(marks))
    solved = np.linalg.solve(system, across.T @ (goal * of_row))
    weights = np.concatenate([anchor.T.astype(np.float64) @ solved, np.zeros((1, len(langs)))])
    return Model(langs, column, weights.astype(np.float32))


def predict(model: Model, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Language (object array) and score of every text of a column."""
    n, width = len(texts), len(model.weights)
    lang, score = np.full(n, UNDETERMINED, dtype=object), np.zeros(n)
    if not model.langs or n == 0:
        return lang, score
    low = lowered(texts)
    letters = pc.match_substring_regex(low, r"\p{L}").to_numpy(zero_copy_only=False)
    for first, last, data, offsets in tx.text_chunks(low):
        for a in range(0, last - first, 128):  # bounds the presence matrix
            b = min(a + 128, last - first)
            seen = presence(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], model.column, width)
            seen[:, -1] = False
            values = seen.astype(np.float32) @ model.weights
            values /= np.maximum(np.sqrt(seen.sum(axis=1, keepdims=True)), 1.0)
            best = values.argmax(axis=1)
            odds = np.exp(4.0 * (values - values.max(axis=1, keepdims=True)))
            lang[first + a:first + b] = np.array(model.langs, dtype=object)[best]
            score[first + a:first + b] = 1.0 / odds.sum(axis=1)
    lang[~letters], score[~letters] = UNDETERMINED, 0.0
    return lang, np.clip(score, 0.0, 1.0)


def training_sample(docs: DataFrame, rows_per_lang: int, max_langs: int = 200) -> list[tuple[str, str, int]]:
    """At most ``rows_per_lang`` documents of each language: the ids with the
    smallest hashes, ranked before any text moves, and of an id with several rows
    the least text. Ids are made distinct map-side, and every task cuts a
    language's ids to the first ``rows_per_lang`` before one task ranks them, so
    that task reads at most ``rows_per_lang`` ids for each task before it. Of more than ``max_langs`` languages the most
    frequent ones (by name on ties) are learned."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    langs = (known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang")
             .limit(max_langs).select("lang"))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = (known.select("doc_id", "lang").distinct().join(F.broadcast(langs), "lang")
           .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= rows_per_lang))
    rows = (known.join(F.broadcast(ids), ["doc_id", "lang"])  # at most max_langs * rows_per_lang ids
            .groupBy("lang", "doc_id", "rank").agg(F.min("text").alias("text")).collect())
    return sorted((r["lang"], r["text"], r["rank"]) for r in rows)


def learn(docs: DataFrame, rows_per_lang: int = 400, landmarks_per_lang: int = 40) -> Model:
    """Fit on the rows whose ``crc32(doc_id as text) mod 4`` is not 2."""
    return fit(training_sample(docs.select("doc_id", "text", "lang").where(~held_out()), rows_per_lang),
               landmarks_per_lang)


def held_out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


def predictor(spark, model: Model):
    """Column function text -> struct(lang_pred, score)."""
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("lang_pred string, score double")
    def apply(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            lang, score = predict(shared.value, column)
            yield pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score)], ["lang_pred", "score"])

    return apply


def language_id(docs: DataFrame, rows_per_lang: int = 400, landmarks_per_lang: int = 40) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score`` for every document."""
    docs = docs.select("doc_id", "text", "lang")
    apply = predictor(docs.sparkSession, learn(docs, rows_per_lang, landmarks_per_lang))
    return (docs.select("doc_id", held_out().alias("held_out"), apply("text").alias("found"))
            .select("doc_id", "held_out", "found.lang_pred", "found.score"))
