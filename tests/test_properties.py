"""Property tests: tagging columns against the rules as SURVEY §2.9 states
them (first match wins), the regex prefix against Python's ``re``, the
positional combine against pandas' ``concat`` and the second-level grouping
against pandas' ``groupby``, on random inputs."""

from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st

from trafficlens.functions import tagging as tag

FRAGMENTS = ["second", "new-building", "(not set)", "serp", "SERP", "card", "Card", "protection",
             "guarantee", "onlinebuy", "click", "View", "moskva", "sankt-peterburg", "mosk", "lening",
             "sankt-", "_", "x", ""]
texts = st.lists(st.sampled_from(FRAGMENTS), min_size=0, max_size=4).map("".join)


def first_match(rules, default=None):
    def apply(s):
        for test, label in rules:
            if test(s):
                return label
        return default
    return apply


RULES = {
    "campaign": first_match([(lambda s: "second" in s, tag.CAMPAIGN_SECONDARY),
                             (lambda s: "new-building" in s, tag.CAMPAIGN_NEW_BUILD),
                             (lambda s: s == "(not set)", tag.CAMPAIGN_NON_AD)], tag.CAMPAIGN_OTHER),
    "location": first_match([(lambda s: "serp" in s.lower(), "SERP"), (lambda s: "card" in s.lower(), "CARD")]),
    "product": first_match([(lambda s: "protection" in s.lower() or "guarantee" in s.lower(), "protection"),
                            (lambda s: "onlinebuy" in s.lower(), "onlinebuy")]),
    "action": first_match([(lambda s: "click" in s.lower(), "click"), (lambda s: "view" in s.lower(), "view")]),
    "geo": first_match([(lambda s: any(g in s for g in tag.GEO_MSK), "MSK"),
                        (lambda s: any(g in s for g in tag.GEO_SPB), "SPB")]),
    "city": first_match([(lambda s: "mosk" in s, "MSK"), (lambda s: "sankt-" in s or "lening" in s, "SPB")], "REG"),
}
COLUMNS = {
    "campaign": tag.campaign_type, "location": tag.tag_location, "product": tag.tag_product,
    "action": tag.tag_action, "geo": tag.tag_geo, "city": lambda c: tag.city_bucket(c, "REG"),
}


@settings(max_examples=15, deadline=None)
@given(values=st.lists(texts, min_size=1, max_size=40))
def test_tag_columns_follow_the_stated_rules(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = df.select("s", *[fn("s").alias(name) for name, fn in COLUMNS.items()]).collect()
    for row in got:
        for name, rule in RULES.items():
            assert row[name] == rule(row.s), (name, row.s)


@settings(max_examples=15, deadline=None)
@given(values=st.lists(st.text(alphabet="ab_", max_size=6), min_size=1, max_size=40))
def test_regex_prefix_is_the_text_before_the_first_separator(spark, values):
    import re

    df = spark.createDataFrame([(v,) for v in values], "s string")
    for row in df.select("s", tag.regex_prefix("s").alias("p")).collect():
        m = re.search(r"(.*?)_.*?", row.s)
        assert row.p == (m.group(1) if m else None), row.s


@settings(max_examples=10, deadline=None)
@given(weeks=st.lists(st.sets(st.integers(min_value=1, max_value=12), max_size=8), min_size=2, max_size=4))
def test_positional_combine_equals_pandas_concat(spark, weeks):
    """Position mode lines frames up like pandas' ``concat(axis=1)`` of frames
    sorted by week (the first frame's week kept), including missing weeks."""
    import pandas as pd

    from trafficlens.operators.joins import combine

    frames, pdfs = [], []
    for i, ws in enumerate(weeks):
        rows = [(w, w * 10 + i) for w in sorted(ws)]
        frames.append(spark.createDataFrame(rows, f"isoweek bigint, v{i} bigint"))
        pdf = pd.DataFrame(rows, columns=["isoweek", f"v{i}"])
        pdfs.append(pdf if i == 0 else pdf.drop(columns=["isoweek"]))
    want = pd.concat(pdfs, axis=1)
    got = [tuple(r) for r in combine(frames, how="position").collect()]
    expected = [tuple(None if pd.isna(x) else int(x) for x in row) for row in want.itertuples(index=False)]
    assert got == expected


@settings(max_examples=10, deadline=None)
@given(rows=st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from([1, 2, None]),
                               st.integers(min_value=0, max_value=9)), min_size=1, max_size=30))
def test_second_level_equals_pandas_groupby(spark, rows):
    """Pandas ``groupby(keys).agg(out=(col, 'sum'))`` drops NULL keys and
    sorts by the keys."""
    import pandas as pd

    from trafficlens.operators.aggregates import second_level

    df = spark.createDataFrame(rows, "k1 string, k2 bigint, v bigint")
    got = [tuple(r) for r in second_level(df, ["k1", "k2"], {"s": "v"}).collect()]
    pdf = pd.DataFrame(rows, columns=["k1", "k2", "v"]).astype({"k2": "Int64"})
    want = pdf.groupby(["k1", "k2"]).agg(s=("v", "sum")).reset_index()
    assert got == [(r.k1, int(r.k2), int(r.s)) for r in want.itertuples(index=False)]


@settings(max_examples=10, deadline=None)
@given(weeks=st.lists(st.sets(st.integers(min_value=1, max_value=12), max_size=8), min_size=2, max_size=4))
def test_keyed_combine_equals_an_outer_merge_on_the_week(spark, weeks):
    from functools import reduce

    import pandas as pd

    from trafficlens.operators.joins import combine

    frames, pdfs = [], []
    for i, ws in enumerate(weeks):
        rows = [(w, w * 10 + i) for w in sorted(ws)]
        frames.append(spark.createDataFrame(rows, f"isoweek bigint, v{i} bigint"))
        pdfs.append(pd.DataFrame(rows, columns=["isoweek", f"v{i}"]))
    want = reduce(lambda a, b: a.merge(b, on="isoweek", how="outer"), pdfs)
    expected = sorted(tuple(None if pd.isna(x) else int(x) for x in row) for row in want.itertuples(index=False))
    got = sorted(tuple(r) for r in combine(frames, how="key").collect())
    assert got == expected
