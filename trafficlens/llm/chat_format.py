"""Chat formatting: preference pairs with one prompt and masked completions.

A pair holds a chosen and a rejected conversation. Their longest common prefix
of turns (equal role and text) is rendered once as the prompt; what follows in
each is its completion, with a mask of character spans: 1 for assistant turns,
which are learned, 0 for all others. Everything is a built-in Spark function.

``swapped_replies`` makes pairs from plain conversations: the rejected one is the
conversation with its last assistant turn replaced by that of the neighbour
conversation (``conv_id`` with the lowest bit flipped), or removed where the
neighbour has none. One row per conversation is built and joined on unique ids,
so copies of a conversation or a common first turn are no hot keys.

Bound: a conversation is one row, its turns are collected in one task and its
rendering is one value. One past 2 GB fails the job; nothing is cut off.

Defined cases: turns go by ``turn``, ties by role and text; a null role is
``user``, a null text empty; rows without ``conv_id`` belong to no conversation
and are left out; a conversation without an assistant turn has no rejected form
(null completions, ``status`` "no reply"); equal conversations have the whole
conversation as prompt, empty completions and ``status`` "equal"; an empty table
gives an empty one. Only ``conv_id``, ``turn``, ``role`` and ``text`` are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, MIDDLE, CLOSE = "<|", "|>\n", "<|end|>\n"


def conversations_as_rows(turns: DataFrame) -> DataFrame:
    """``conv_id, turns``: one row a conversation, ``turns`` an array of (role, text)."""
    turn = F.struct(F.col("turn").alias("turn"), F.coalesce("role", F.lit("user")).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text"))
    return (turns.where(F.col("conv_id").isNotNull()).groupBy("conv_id")
            .agg(F.sort_array(F.collect_list(turn)).alias("t"))
            .select("conv_id", F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))
                    .alias("turns")))


def last_reply_at(turns: Column) -> Column:
    """Place (from 0) of the last assistant turn, -1 without one."""
    return F.array_max(F.concat(F.array(F.lit(-1)), F.filter(
        F.transform(turns, lambda x, i: F.when(x["role"] == "assistant", i)), lambda i: i.isNotNull())))


def swapped_replies(turns: DataFrame) -> DataFrame:
    """``conv_id, chosen, rejected`` for every conversation."""
    convs = conversations_as_rows(turns).withColumn("at", last_reply_at(F.col("turns")))
    replies = convs.where(F.col("at") >= 0).select(
        F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"), F.get("turns", F.col("at"))["text"].alias("reply"))
    swapped = F.struct(F.lit("assistant").alias("role"), F.col("reply").alias("text"))
    rejected = F.concat(
        F.slice("turns", F.lit(1), F.greatest("at", F.lit(0))),
        F.when(F.col("reply").isNotNull(), F.array(swapped)).otherwise(F.slice("turns", 1, 0)),
        F.slice("turns", F.col("at") + 2, F.size("turns")))
    return convs.join(replies, "conv_id", "left").select(
        "conv_id", F.col("turns").alias("chosen"), F.when(F.col("at") >= 0, rejected).alias("rejected"))


def render(turns: Column) -> Column:
    """Text of an array of turns."""
    return F.array_join(F.transform(turns, rendered_turn), "")


def rendered_turn(x: Column) -> Column:
    return F.concat(F.lit(OPEN), x["role"], F.lit(MIDDLE), x["text"], F.lit(CLOSE))


def mask(turns: Column) -> Column:
    """Spans of a rendered completion in order, as ``length:learned`` joined by
    commas; the head of a turn is never learned, text and end of an assistant turn are."""
    return F.array_join(F.transform(turns, lambda x: F.concat(
        F.length(F.concat(F.lit(OPEN), x["role"], F.lit(MIDDLE))).cast("string"), F.lit(":0,"),
        F.length(F.concat(x["text"], F.lit(CLOSE))).cast("string"),
        F.when(x["role"] == "assistant", F.lit(":1")).otherwise(F.lit(":0")))), ",")


def format_preferences(pairs: DataFrame) -> DataFrame:
    """``conv_id, status, n_common, prompt, chosen, rejected, chosen_mask,
    rejected_mask`` for every row of ``conv_id, chosen, rejected``."""
    # First place where the two differ, else the length of the shorter.
    shorter = F.least(F.size("chosen"), F.size("rejected"))
    differing = F.filter(
        F.transform("chosen", lambda x, i: F.when(~x.eqNullSafe(F.get("rejected", i)), i)), lambda i: i.isNotNull())
    counted = pairs.withColumn("n_common", F.when(
        F.col("rejected").isNotNull(),
        F.least(shorter, F.coalesce(F.array_min(differing), shorter))).cast("long"))
    rest = lambda side: F.slice(side, F.col("n_common").cast("int") + 1, F.size(side))
    parts = counted.select(
        "conv_id", "n_common",
        F.slice("chosen", F.lit(1), F.coalesce("n_common", F.size("chosen")).cast("int")).alias("common"),
        rest("chosen").alias("c"), rest("rejected").alias("r"))
    return parts.select(
        "conv_id",
        F.when(F.col("n_common").isNull(), "no reply")
        .when((F.size("c") == 0) & (F.size("r") == 0), "equal").otherwise("pair").alias("status"),
        "n_common", render(F.col("common")).alias("prompt"),
        render(F.col("c")).alias("chosen"), render(F.col("r")).alias("rejected"),
        mask(F.col("c")).alias("chosen_mask"), mask(F.col("r")).alias("rejected_mask"))


def preference_format(turns: DataFrame) -> DataFrame:
    """Formatted pairs of all conversations of a turn table."""
    return format_preferences(swapped_replies(turns.select("conv_id", "turn", "role", "text")))


def preference_sql(source: str = "conversations") -> str:
    """DuckDB SQL for the rows of ``preference_format``."""
    head = f"'{OPEN}' || role || '{MIDDLE.rstrip()}' || chr(10)"
    body = f"text || '{CLOSE.rstrip()}' || chr(10)"
    return f"""
WITH t AS (
  SELECT conv_id, coalesce(role, 'user') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id
                            ORDER BY turn NULLS FIRST, coalesce(role, 'user'), coalesce(text, '')) AS i
  FROM {source} WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, max(i) AS n, max(CASE WHEN role = 'assistant' THEN i END) AS last FROM t GROUP BY conv_id),
y AS (SELECT xor(c.conv_id, 1) AS conv_id, text AS reply FROM c JOIN t ON t.conv_id = c.conv_id AND t.i = c.last),
r AS (
  SELECT t.conv_id, t.role, CASE WHEN i = last THEN reply ELSE text END AS text,
         CASE WHEN i > last AND reply IS NULL THEN i - 1 ELSE i END AS i
  FROM t JOIN c USING (conv_id) LEFT JOIN y USING (conv_id)
  WHERE last IS NOT NULL AND NOT (i = last AND reply IS NULL)),
d AS (
  SELECT coalesce(t.conv_id, r.conv_id) AS conv_id, min(coalesce(t.i, r.i)) AS i
  FROM t FULL JOIN r ON t.conv_id = r.conv_id AND t.i = r.i
  WHERE t.i IS NULL OR r.i IS NULL OR t.role <> r.role OR t.text <> r.text GROUP BY 1),
k AS (
  SELECT c.conv_id, CASE WHEN c.last IS NULL THEN NULL ELSE coalesce(d.i - 1, c.n) END AS n_common
  FROM c LEFT JOIN d USING (conv_id)),
cs AS (
  SELECT k.conv_id, n_common,
         coalesce(string_agg({head} || {body}, '' ORDER BY i) FILTER (n_common IS NULL OR i <= n_common), '') AS prompt,
         coalesce(string_agg({head} || {body}, '' ORDER BY i) FILTER (i > n_common), '') AS chosen,
         coalesce(string_agg(length({head}) || ':0,' || length({body}) ||
                  CASE WHEN role = 'assistant' THEN ':1' ELSE ':0' END, ',' ORDER BY i) FILTER (i > n_common), '')
           AS chosen_mask
  FROM k JOIN t USING (conv_id) GROUP BY 1, 2),
rs AS (
  SELECT k.conv_id,
         coalesce(string_agg({head} || {body}, '' ORDER BY i) FILTER (i > n_common), '') AS rejected,
         coalesce(string_agg(length({head}) || ':0,' || length({body}) ||
                  CASE WHEN role = 'assistant' THEN ':1' ELSE ':0' END, ',' ORDER BY i) FILTER (i > n_common), '')
           AS rejected_mask
  FROM k JOIN r USING (conv_id) GROUP BY 1)
SELECT conv_id,
       CASE WHEN n_common IS NULL THEN 'no reply'
            WHEN chosen = '' AND coalesce(rejected, '') = '' THEN 'equal' ELSE 'pair' END AS status,
       CAST(n_common AS BIGINT) AS n_common, prompt,
       CASE WHEN n_common IS NOT NULL THEN chosen END AS chosen,
       CASE WHEN n_common IS NOT NULL THEN coalesce(rejected, '') END AS rejected,
       CASE WHEN n_common IS NOT NULL THEN chosen_mask END AS chosen_mask,
       CASE WHEN n_common IS NOT NULL THEN coalesce(rejected_mask, '') END AS rejected_mask
FROM cs LEFT JOIN rs USING (conv_id)
"""
