from __future__ import annotations

import zlib

from trafficlens.llm import language_id as li
from trafficlens.llm.tables import read_table


def test_held_out_accuracy(spark):
    docs = read_table(spark, "/root/testdata/sf0.01", "documents", "doc_id", "text", "lang")
    rows = li.language_id(docs, rows_per_lang=150, landmarks_per_lang=20).join(docs.select("doc_id", "lang"), "doc_id") \
        .collect()
    assert len(rows) == 1000
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_presence_equals_sets_of_byte_ngrams():
    import numpy as np
    import pyarrow as pa
    texts = ["abab abc", "", "x", "é日本", "abcab" * 50]
    column, seen = np.zeros(1 << li.SLOT_BITS, np.int64), {}
    for t in texts:
        b = t.encode()
        for k in li.ORDERS:
            for i in range(len(b) - k + 1):
                seen.setdefault(int(li.slots(np.frombuffer(b[i:i + k], np.uint8), k)[0]), len(seen))
    for slot, place in seen.items():
        column[slot] = place
    got = li.all_presence(texts, column, len(seen) + 1)
    for row, t in zip(got, texts, strict=True):
        b = t.encode()
        want = {seen[int(li.slots(np.frombuffer(b[i:i + k], np.uint8), k)[0])]
                for k in li.ORDERS for i in range(len(b) - k + 1)}
        assert set(np.flatnonzero(row)) == want
    assert pa.array(texts) is not None


def test_edge_rows(make_docs):
    rows = [(i, "the cat and the dog of the house " * 3, "en", None) for i in range(20)]
    rows += [(i, "der hund und die katze von dem haus " * 3, "de", None) for i in range(20, 40)]
    rows += [(50, None, "en", None), (51, "", None, None), (52, "123 !!", "en", None), (53, "the cat", None, None),
             (None, "der hund und die katze", None, None), (54, "the cat and the dog " * 20_000, None, None)]
    docs = make_docs(rows)
    got = {r["doc_id"]: r for r in li.language_id(docs).collect()}
    assert len(got) == len(rows)
    assert [got[i]["lang_pred"] for i in (50, 51, 52, 53, None, 54)] == ["und", "und", "und", "en", "de", "en"]
    assert got[50]["score"] == 0.0 and got[None]["held_out"] is None
    assert li.language_id(docs.limit(0)).collect() == []
    none = make_docs([(1, "the cat", None, None)])
    assert [r["lang_pred"] for r in li.language_id(none).collect()] == ["und"]


def test_many_rows_of_one_id_and_many_languages(make_docs):
    """One id with 20,000 rows is one document of the sample, and no language loses its rows to it."""
    rows = [(1, f"the cat and the dog {i % 3}", "en", None) for i in range(20_000)]
    rows += [(i, "the house and the garden", "en", None) for i in range(2, 30)]
    rows += [(i, "der hund und die katze", "de", None) for i in range(30, 40)]
    docs = make_docs(rows).select("doc_id", "text", "lang")
    sample = li.training_sample(docs, 10)
    assert [sum(lang == x for lang, _, _ in sample) for x in ("de", "en")] == [10, 10]
    assert sorted(rank for lang, _, rank in sample if lang == "en") == list(range(1, 11))
    everything = li.training_sample(docs, 1000)
    assert len(everything) == 39 and ("the cat and the dog 0") in [t for _, t, _ in everything]
    assert {lang for lang, _, _ in li.training_sample(docs, 10, max_langs=1)} == {"en"}


def test_folded_weights_equal_an_unfolded_kernel_ridge(make_docs):
    """Kernel values from n-gram sets, one solve over the landmarks, scores from kernels."""
    import numpy as np
    import pyarrow as pa
    rng = np.random.default_rng(3)
    words = {"aa": ["the", "cat", "house", "garden"], "bb": ["der", "hund", "katze", "haus"], "cc": ["le", "chat", "maison"]}
    rows = [(lang, " ".join(rng.choice(w, 6)), rank) for lang, w in words.items() for rank in range(1, 9)]
    rows = sorted(rows)
    ridge = 1e-3
    model = li.fit(rows, landmarks_per_lang=3, ridge=ridge)
    grams = lambda t: {(k, t.encode()[i:i + k]) for k in li.ORDERS for i in range(len(t.encode()) - k + 1)}
    marks = [grams(t) for _, t, rank in rows if rank <= 3]
    known = set().union(*marks)

    def kernel(a, b):
        a, b = a & known, b & known
        return len(a & b) / (max(len(a), 1) * max(len(b), 1)) ** 0.5

    langs = sorted(words)
    of_rows = np.array([[kernel(grams(t), m) for m in marks] for _, t, _ in rows])
    of_marks = np.array([[kernel(a, b) for b in marks] for a in marks])
    goal = np.array([[1.0 if lang == x else -1.0 for x in langs] for lang, _, _ in rows])
    share = 1.0 / 8  # rows of a language
    alpha = np.linalg.solve(share * of_rows.T @ of_rows + ridge * of_marks + 1e-8 * np.eye(len(marks)),
                            share * of_rows.T @ goal)
    texts = ["the hund", "le chat et la maison", "haus", "zzz qqq", "the cat the cat the garden"]
    want = np.array([[kernel(grams(t), m) for m in marks] for t in texts]) @ alpha
    lang, score = li.predict(model, pa.array(texts))
    odds = np.exp(4 * (want - want.max(axis=1, keepdims=True)))
    assert np.allclose(score.astype(float), 1 / odds.sum(axis=1), atol=1e-3)
    clear = np.sort(want, axis=1)[:, -1] - np.sort(want, axis=1)[:, -2] > 1e-3
    assert [x for x, c in zip(lang, clear, strict=True) if c] == [langs[i] for i, c in zip(want.argmax(axis=1), clear,
                                                                                          strict=True) if c]
