"""Source divergence audit: which sources of a language use its vocabulary unlike
the others, and by which terms.

Per language a count vectorizer without a vocabulary limit (``min_df`` documents
at least) turns every document into its sparse vector of term counts; the vectors
are summed per (lang, source) as they are built, so what leaves a task is one row
a term and group with its count and document count. The terms themselves are the
keys of all shuffles and the vocabulary stays a Spark table: it grows with the
corpus, so it is neither sent to the driver nor broadcast (``pyspark.ml``'s
CountVectorizer does both; see the README for its figures). Documents are single
chunks of text to a task; terms meet by 64-bit hashes only within a chunk.

Probabilities are integers, ``p = 1 + floor(SCALE * (count + 1) / (N + V))``, and
``f(p, q) = floor((p - q)^2 / q)``; all sums are exact. Pairs of sources are
evaluated sparsely. A term that a source lacks has that source's constant ``p0``,
so for sources g, h of a language with V terms

    sum f(pg, ph) = sum over g's terms of f(pg, p0h) + sum over h's terms of f(p0g, ph)
                  + (V - |g| - |h|) f(p0g, p0h)
                  + sum over common terms of f(pg, ph) - f(pg, p0h) - f(p0g, ph) + f(p0g, p0h)

The first two sums need each source's histogram of p only. The last is taken in
tasks over shards of the vocabulary, term by term as outer products of its
holders, and leaves a task as one partial sum a pair.

Defined cases: null text, lang and source are ''; every row is a document, also
one that repeats another; a group without kept terms has ``p0`` everywhere; a
language without kept terms has value 0 for every pair and no term rows; an empty
table gives no rows. Counts may exceed 2^53; they are summed as long. Only
``lang``, ``source`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trafficlens.llm import textops as tx
from trafficlens.llm.tables import Scratch

MIN_DF = 3
SCALE = 1_000_000_000
TOP_TERMS = 200
CHUNK_BYTES = 2 << 20
OUTER = 1 << 20  # entries of the outer products held at once

# Letters A-Z, a-z and every byte of a character beyond ASCII.
_TERM = np.zeros(256, dtype=bool)
_TERM[65:91] = _TERM[97:123] = _TERM[128:] = True

_RESULT = "lang string, source string, part string, item string, value long, rank int"


def term_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte spans of the terms and the document of each."""
    inside = _TERM[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True  # no term reaches across documents
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    stops[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def _strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    lens = ends - starts
    cuts = np.concatenate(([0], np.cumsum(lens)))
    at = np.arange(int(cuts[-1])) + np.repeat(starts - cuts[:-1], lens)
    return pa.LargeStringArray.from_buffers(
        len(lens), pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(data[at])).cast(pa.string())


def group_term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, df``: occurrences and documents of each term in each
    group. Document vectors are summed per chunk, task and then group."""

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = pa.StructArray.from_arrays([batch.column("lang").fill_null(""), batch.column("source").fill_null("")],
                                               ["lang", "source"])
            seen: dict[tuple, int] = {}
            group = np.array([seen.setdefault((x["lang"], x["source"]), len(seen)) for x in names.to_pylist()], np.uint64)
            langs, sources = (pa.array([k[i] for k in seen], pa.string()) for i in (0, 1))
            for first, _, data, offsets in tx.text_chunks(batch.column("text"), CHUNK_BYTES):
                data = tx.lower_ascii(data)
                starts, ends, doc = term_spans(data, offsets)
                if not len(starts):
                    continue
                of = group[first + doc]
                key = tx.mix64(tx.span_hashes(data, starts, ends) + of * np.uint64(0x9E3779B97F4A7C15))
                order = np.argsort(key, kind="stable")  # documents stay in order within a key
                key, doc = key[order], doc[order]
                fresh = np.concatenate(([True], key[1:] != key[:-1]))
                at = np.flatnonzero(fresh)
                other_doc = fresh.copy()
                other_doc[1:] |= doc[1:] != doc[:-1]
                one = order[at]
                code = pa.array(of[one].astype(np.int64))
                yield pa.RecordBatch.from_pydict({
                    "lang": langs.take(code), "source": sources.take(code),
                    "term": _strings(data, starts[one], ends[one]),
                    "n": pa.array(np.diff(np.append(at, len(key))).astype(np.int64)),
                    "df": pa.array(np.add.reduceat(other_doc.astype(np.int64), at))})

    rows = docs.select(*(F.col(c).cast("string").alias(c) for c in ("lang", "source", "text"))).mapInArrow(
        vectors, "lang string, source string, term string, n long, df long")
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def _p(count: str, total: str, terms: str):
    """1 + floor(SCALE * (count + 1) / (total + terms)), as long."""
    return F.expr(f"1 + cast(({SCALE}BD * cast({count} + 1 as decimal(20, 0))) div cast({total} + {terms} as decimal(20, 0)) "
                  "as bigint)")


def _f(p: str, q: str):
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


def common_term_sums(terms: DataFrame) -> DataFrame:
    """``lang, g, h, common``: over the terms that both sources of a pair have, the
    sum of f(pg, ph) - f(pg, p0h) - f(p0g, ph) + f(p0g, p0h)."""
    schema = "lang string, g string, h string, common long"

    def f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return (p - q) ** 2 // q

    def products(codes: np.ndarray, p: np.ndarray, p0: np.ndarray, a: slice) -> tuple[np.ndarray, ...]:
        """Holders ``a`` of each term (rows) against all its holders."""
        pg, p0g = p[:, a, None], p0[:, a, None]
        ph, p0h = p[:, None, :], p0[:, None, :]
        value = f(pg, ph) - f(pg, p0h) - f(p0g, ph) + f(p0g, p0h)
        g, h = np.broadcast_arrays(codes[:, a, None], codes[:, None, :])
        return g.ravel(), h.ravel(), value.ravel()

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang, names, codes = None, [], {}
        parts: list[tuple] = []
        held = 0
        open_rows: list[pa.RecordBatch] = []

        def folded() -> tuple | None:
            nonlocal held
            if not parts:
                return None
            g, h, v = (np.concatenate(c) for c in zip(*parts, strict=True))
            key, place = np.unique(g * len(names) + h, return_inverse=True)
            total = np.zeros(len(key), np.int64)
            np.add.at(total, place, v)
            parts[:] = [(key // len(names), key % len(names), total)]
            held = len(key)
            return parts[0]

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held
            found = folded()
            if found is not None:
                name = pa.array(names, pa.string())
                g, h, v = found
                other = g != h
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([lang] * int(other.sum()), pa.string()), "g": name.take(pa.array(g[other])),
                    "h": name.take(pa.array(h[other])), "common": pa.array(v[other])})
            parts.clear()
            held = 0

        def add(table: pa.Table) -> Iterator[pa.RecordBatch]:
            """Whole terms of one language, sorted by term."""
            nonlocal held
            term = table.column("term").combine_chunks().dictionary_encode().indices.to_numpy()
            code = np.array([codes.setdefault(s, len(codes)) for s in table.column("source").to_pylist()], np.int64)
            names.extend(list(codes)[len(names):])
            p, p0 = table.column("p").to_numpy(), table.column("p0").to_numpy()
            begins = np.flatnonzero(np.concatenate(([True], term[1:] != term[:-1])))
            holders = np.diff(np.append(begins, len(term)))
            for s in np.unique(holders[holders > 1]).tolist():
                at = begins[holders == s]
                step, wide = max(1, OUTER // (s * s)), max(1, min(s, OUTER // s))
                for i in range(0, len(at), step):
                    rows = at[i:i + step, None] + np.arange(s)[None, :]
                    for w in range(0, s, wide):
                        parts.append(products(code[rows], p[rows], p0[rows], slice(w, w + wide)))
                        held += len(parts[-1][0])
                        if held > 4 * OUTER:
                            folded()
                            if held > 2 * OUTER:
                                yield from flush()

        for batch in batches:
            langs, terms_ = batch.column("lang"), batch.column("term")
            codes_ = pa.StructArray.from_arrays([langs, terms_], ["l", "t"])
            n = len(codes_)
            if not n:
                continue
            l_, t_ = (x.dictionary_encode().indices.to_numpy() for x in (langs, terms_))
            cuts = [0, *(np.flatnonzero(l_[1:] != l_[:-1]) + 1).tolist(), n]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                here = langs[a].as_py()
                if here != lang:
                    if open_rows:
                        yield from add(pa.Table.from_batches(open_rows))
                        open_rows.clear()
                    yield from flush()
                    lang, names, codes = here, [], {}
                # the last term of the piece may go on in the next batch
                last = a + int(np.flatnonzero(t_[a:b] == t_[b - 1])[0])
                if last > a or (open_rows and open_rows[-1].column("term")[0].as_py() != terms_[a].as_py()):
                    whole = [*open_rows, *([batch.slice(a, last - a)] if last > a else [])]
                    yield from add(pa.Table.from_batches(whole))
                    open_rows.clear()
                open_rows.append(batch.slice(last, b - last))
        if open_rows:
            yield from add(pa.Table.from_batches(open_rows))
        yield from flush()

    dealt = terms.repartition("lang", "term").sortWithinPartitions("lang", "term")
    return (dealt.select("lang", "term", "source", "p", "p0").mapInArrow(sums, schema)
            .groupBy("lang", "g", "h").agg(F.sum("common").alias("common")))


def source_divergence(docs: DataFrame, min_df: int = MIN_DF, top_terms: int = TOP_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank`` (see the module text)."""
    docs = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    scratch = Scratch(docs.sparkSession, "source-divergence")
    counts = scratch.keep(group_term_counts(docs), "counts")
    vocabulary = (counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("df").alias("df"))
                  .where(F.col("df") >= min_df).select("lang", "term", "lang_n"))
    kept = scratch.keep(counts.select("lang", "source", "term", "n").join(vocabulary, ["lang", "term"]), "kept")
    sizes = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("own"))
    # a language's terms: each is counted at its first source only
    per_lang = (kept.groupBy("lang", "term").agg(F.first("lang_n").alias("n"))
                .groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("n").alias("lang_total")))
    zero = F.lit(0).cast("long")
    groups = (docs.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left")
              .join(per_lang, "lang", "left")
              .select("lang", "source", *(F.coalesce(c, zero).alias(c) for c in ("total", "own", "v", "lang_total")))
              .withColumn("p0", F.when(F.col("v") > 0, _p("0", "total", "greatest(v, 1)")).otherwise(F.lit(1).cast("long"))))
    groups = scratch.keep(groups, "groups")
    terms = scratch.keep(
        kept.join(groups, ["lang", "source"])
        .select("lang", "source", "term", "p0", _p("n", "total", "v").alias("p"), _p("lang_n", "lang_total", "v").alias("q")),
        "terms")

    ranked = lambda df, last: (
        df.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))
        .where(F.col("rank") <= last) if last else
        df.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))))
    of_terms = ranked(terms.where(F.col("p") > F.col("q"))
                      .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                              _f("p", "q").alias("value")), top_terms)

    other = groups.select("lang", F.col("source").alias("y"), F.col("p0").alias("y0"))
    halves = scratch.keep(
        terms.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("m")).join(other, "lang")
        .where(F.col("source") != F.col("y"))
        .groupBy("lang", F.col("source").alias("x"), "y")
        .agg(F.sum(F.col("m") * _f("p", "y0")).alias("a"), F.sum(F.col("m") * _f("y0", "p")).alias("b")), "halves")
    pairs = (groups.select("lang", F.col("source").alias("g"), F.col("own").alias("g_own"), F.col("p0").alias("g0"), "v")
             .join(groups.select("lang", F.col("source").alias("h"), F.col("own").alias("h_own"), F.col("p0").alias("h0")), "lang")
             .where(F.col("g") != F.col("h"))
             .join(halves.select("lang", F.col("x").alias("g"), F.col("y").alias("h"), "a"), ["lang", "g", "h"], "left")
             .join(halves.select("lang", F.col("x").alias("h"), F.col("y").alias("g"), "b"), ["lang", "g", "h"], "left")
             .join(common_term_sums(terms), ["lang", "g", "h"], "left"))
    value = (F.coalesce("a", zero) + F.coalesce("b", zero) + F.coalesce("common", zero)
             + (F.col("v") - F.col("g_own") - F.col("h_own")) * _f("g0", "h0"))
    of_pairs = ranked(pairs.select("lang", F.col("g").alias("source"), F.lit("pair").alias("part"),
                                   F.col("h").alias("item"),
                                   F.when(F.col("v") > 0, value).otherwise(zero).alias("value")), None)
    return scratch.result(of_pairs.unionByName(of_terms))


def source_divergence_sql() -> str:
    """DuckDB SQL of the query, dense: every kept term for every group."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    p = f"1 + ({SCALE}::HUGEINT * ({{}} + 1)) // ({{}} + {{}})"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                     translate(coalesce(text, ''), '{upper}', '{upper.lower()}') AS text FROM documents),
words AS (SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM docs),
vocab AS (SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT id) >= {MIN_DF}),
langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM vocab GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n FROM words GROUP BY ALL),
cells AS (SELECT g.lang, g.source, w.term, coalesce(c.n, 0) AS n, w.n AS lang_n,
                 sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS total
          FROM groups g JOIN vocab w USING (lang) LEFT JOIN counts c USING (lang, source, term)),
probs AS (SELECT c.lang, source, term, n, {p.format('n', 'c.total', 'v')} AS p, {p.format('lang_n', 'l.total', 'v')} AS q
          FROM cells c JOIN langs l USING (lang)),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
          FROM probs a JOIN probs b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(value, 0) AS value
          FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source
          LEFT JOIN pairs p ON p.lang = g.lang AND p.source = g.source AND p.item = h.source
          UNION ALL
          SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM probs WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank
FROM found QUALIFY part = 'pair' OR rank <= {TOP_TERMS}
"""
