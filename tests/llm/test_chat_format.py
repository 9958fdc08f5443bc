from __future__ import annotations

import duckdb
import pandas as pd

from trafficlens.llm import chat_format as cf

SCHEMA = "conv_id long, turn long, role string, text string, chosen string, status int, n_common int"


def run(spark, rows):
    return cf.preference_format(spark.createDataFrame([r + ("mine", 1, 2) for r in rows], SCHEMA))


ROWS = [
    (0, 0, "user", "hi"), (0, 1, "assistant", "hello"), (0, 2, "user", "more"), (0, 3, "assistant", "fine"),
    (1, 0, "user", "hi"), (1, 1, "assistant", "hey"),
    (2, 0, "user", "q"), (2, 1, "assistant", "same"), (3, 0, "system", "s"), (3, 1, "assistant", "same"),
    (4, 0, "user", "only"), (5, 0, "user", "q"), (5, 1, "assistant", "a"), (5, 2, "user", "thanks"),
    (6, 0, None, None), (6, 1, "assistant", None), (None, 0, "user", "lost"),
    (8, 1, "assistant", "b"), (8, 1, "assistant", "a"), (8, None, "user", "x"), (9, 0, "assistant", "a"),
    (9, 0, "assistant", "a"),
]


def test_rows_equal_sql(spark):
    got = run(spark, ROWS).toPandas()
    conversations = pd.DataFrame(ROWS, columns=["conv_id", "turn", "role", "text"]).astype(
        {"conv_id": "Int64", "turn": "Int64"})
    con = duckdb.connect()
    con.register("conversations", conversations)
    want = con.execute(cf.preference_sql()).df()[list(got.columns)]
    clean = lambda d: sorted((tuple(None if pd.isna(v) else v for v in r) for r in d.itertuples(index=False)),
                             key=str)
    assert clean(got) == clean(want)


def test_known_pair(spark):
    by = {r["conv_id"]: r for r in run(spark, ROWS).collect()}
    r = by[0]
    assert r["n_common"] == 3 and r["prompt"].endswith("<|user|>\nmore<|end|>\n") and r["status"] == "pair"
    assert r["chosen"] == "<|assistant|>\nfine<|end|>\n" and r["rejected"] == "<|assistant|>\nhey<|end|>\n"
    assert r["chosen_mask"] == "14:0,12:1"
    assert by[2]["status"] == by[3]["status"] == "equal" and by[2]["chosen"] == ""
    assert by[4]["status"] == "no reply" and by[4]["rejected"] is None
    assert by[5]["rejected"] == "<|user|>\nthanks<|end|>\n"  # the neighbour has no reply
    assert None not in by


def test_masks_cover_the_completions(spark):
    for r in run(spark, ROWS + [(20, 0, "user", "x" * 200_000), (20, 1, "assistant", "y" * 300_000)]).collect():
        for side in ("chosen", "rejected"):
            if r[side] is not None:
                spans = [int(s.split(":")[0]) for s in r[f"{side}_mask"].split(",") if s]
                assert sum(spans) == len(r[side])


def test_given_pairs(spark):
    turns = "array<struct<role string, text string>>"
    df = spark.createDataFrame([(1, [("user", "a")], [("user", "a"), ("assistant", "b")]), (2, [], []),
                                (3, [("user", None)], None)], f"conv_id long, chosen {turns}, rejected {turns}")
    got = {r["conv_id"]: r for r in cf.format_preferences(df).collect()}
    assert got[1]["n_common"] == 1 and got[1]["chosen"] == "" and got[1]["rejected"] == "<|assistant|>\nb<|end|>\n"
    assert got[2]["status"] == "equal" and got[3]["status"] == "no reply"


def test_native_plan_and_empty_table(spark):
    df = run(spark, ROWS)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert run(spark, ROWS[:1]).limit(0).collect() == []
    assert cf.preference_format(spark.createDataFrame([], SCHEMA)).collect() == []
