from __future__ import annotations

import collections
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.brute import LOWER
from trafficlens.llm import source_divergence as sd

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, min_df=sd.MIN_DF, top=sd.TOP_TERMS):
    """Every kept term for every group, in Python integers; rows of (text, lang, source)."""
    groups = collections.defaultdict(collections.Counter)
    df = collections.Counter()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        words = TERM.findall((text or "").translate(LOWER))
        groups[lang, source].update(words)
        df.update((lang, w) for w in set(words))
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(w for (l, w), n in df.items() if l == lang and n >= min_df)
        sources = [s for l, s in groups if l == lang]

        def p(counts):
            total = sum(counts[w] for w in kept)
            return {w: 1 + sd.SCALE * (counts[w] + 1) // (total + len(kept)) for w in kept}

        ps = {s: p(groups[lang, s]) for s in sources}
        q = p(sum((groups[lang, s] for s in sources), collections.Counter()))
        f = lambda a, b: (a - b) ** 2 // b
        for s in sources:
            pairs = [(sum(f(ps[s][w], ps[o][w]) for w in kept), o) for o in sources if o != s]
            terms = [(f(ps[s][w], q[w]), w) for w in kept if groups[lang, s][w] > 0 and ps[s][w] > q[w]]
            for part, found, last in (("pair", pairs, len(pairs)), ("term", terms, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, k + 1) for k, (v, item) in enumerate(found[:last])]
    return sorted(out)


def run(spark, rows, parts=3, **kw):
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(parts)
    df = df.withColumn("term", F.lit("mine")).withColumn("n", F.lit(1)).withColumn("rank", F.lit(None))
    return sorted(tuple(r) for r in sd.source_divergence(df, **kw).collect())


def test_edges(spark):
    long = "Maße über-Alles  \x00x\x7Fy 12 a_b " * 4000
    rows = ([("the cat the hat", "en", "a"), ("The CAT sat", "en", "b"), ("a cat, the end", "en", None), (None, "en", "c"),
             ("", "en", "d"), ("the", None, "a"), ("the", None, "b"), ("the", "", "a"), ("", "de", "a"), ("x", "de", "b")]
            + [(long, "fr", s) for s in ("a", "b", "b", "b")] + [("naïve Ünï ÜNÏ naïve", "fr", "c")] * 3)
    got = run(spark, rows)
    assert got == brute(rows)
    assert ("de", "a", "pair", "b", 0, 1) in got  # no term is kept
    assert {r[3] for r in got if r[0] == "" and r[2] == "pair"} == {"a", "b"}


def test_empty_table(spark):
    assert run(spark, []) == []


def test_top_terms_and_ties(spark):
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(60)]
    rows = [(" ".join(words), "en", "a")] * 3 + [("other", "en", "b")] * 3
    got = run(spark, rows, top_terms=7)
    assert got == brute(rows, top=7)
    assert [r[3] for r in got if r[1] == "a" and r[2] == "term"] == sorted(words)[:7]


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["text"], r["lang"], r["source"]) for r in docs.collect()]
    assert run(spark, rows, 7) == brute(rows)


def test_outer_products_in_pieces(spark, monkeypatch):
    rows = [(f"a b c {'d ' * k}", "en", f"s{k}") for k in range(9)] * 2
    want = brute(rows)
    monkeypatch.setattr(sd, "OUTER", 5)  # blocks of holders and partial sums are flushed all the time
    assert run(spark, rows, 1) == want


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.text("aB é1\n", max_size=12), st.sampled_from(["x", "y"]), st.sampled_from("stu")), max_size=25))
def test_small_tables(spark, rows):
    assert run(spark, rows, 2, min_df=2) == brute(rows, 2)
