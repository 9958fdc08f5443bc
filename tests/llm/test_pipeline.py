from __future__ import annotations

import pandas as pd
from brute import WORD, jaccard_components

import corpus_pipeline as cp
from trafficlens.llm import language_id, quality_rules


def staged(spark, docs):
    out = [docs]
    for _, stage in cp.STAGES:
        out.append(stage(spark, out[-1], None).cache())
    return out


def test_rows_equal_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    got = cp.run(spark, sf).toPandas()
    docs = pd.read_parquet(f"{sf}/documents.parquet")
    table = spark.read.parquet(f"{sf}/documents.parquet")
    lang = language_id.language_id(table).toPandas().set_index("doc_id")
    rules = quality_rules.quality_rules(table).toPandas().set_index("doc_id")
    kept = [(i, t) for i, t in zip(docs.doc_id, docs.text, strict=True)
            if lang.lang_pred[i] != "und" and lang.score[i] >= cp.MIN_LANGUAGE_SCORE and rules.kept[i]]
    groups = jaccard_components(kept)
    want = {i: len(WORD.findall(t)) for i, t in kept if groups[i][1] == i}
    assert got.groupby("doc_id").n_words.sum().to_dict() == want
    assert (got.groupby("bin_id").n_words.sum() <= 2048).all()


def test_stages_keep_columns_and_handle_odd_rows(spark, make_docs):
    text = " ".join(f"the word{i} of" for i in range(60))
    other = " ".join(f"and thing{i} to" for i in range(60))
    rows = [(1, text, "en", "a"), (2, text, "en", "b"), (2, text, "en", "b"), (3, other, "en", None), (4, None), (5, ""),
            (6, "123 456"), (None, text, "en", "a"), (8, other + " end", "en", "a"), (9, "the short one", "en", "a")]
    docs = make_docs(rows)
    out = staged(spark, docs)
    assert all(d.columns == docs.columns for d in out[:-1])
    ids = [sorted((r["doc_id"] or 0) for r in d.collect()) for d in out]
    assert ids[1] == [0, 1, 2, 2, 3, 8, 9] and ids[2] == [0, 1, 2, 2, 3, 8] and ids[3] == [0, 1, 3]
    empty = staged(spark, docs.limit(0))
    assert [d.count() for d in empty] == [0] * 5


def test_stage_names_and_order():
    assert [name for name, _ in cp.STAGES] == ["language_id", "quality_rules", "ngram_join", "best_fit_packing"]


def test_repeated_kept_row_stays_once(spark, make_docs):
    text = " ".join(f"the word{i} of" for i in range(60))
    docs = make_docs([(1, text), (1, text), (2, text)])
    assert [r["doc_id"] for r in cp.near_duplicates(spark, docs, "").collect()] == [1]
