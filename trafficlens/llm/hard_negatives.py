"""Hard-negative mining by threshold joins over inverted indexes (L2AP).

Rows are quantised (``floor(256 x)``); a row's score for an anchor is the integer
inner product. Two joins of all anchors with all rows follow each other: the
first gives every anchor its ``positives`` best rows of the same label, the second
fills a window for each of them with the ``negatives`` best rows of other labels
whose score lies between ``LOW`` and ``HIGH`` percent of the positive's.

The rows are dealt into chunks of bounded size by hash, so no label or vector is
hot; every chunk is indexed once and all anchors stream past it. In a chunk the
dimensions are ordered by energy and taken in groups. For a threshold t

* a row is posted under the first groups only: it leaves out the dimensions from
  the first one on whose suffix norm times the anchors' suffix norm is below t;
* partial scores are accumulated group by group, and a row goes when its partial
  score plus the product of the remaining norms is below t for all anchors;
* what is left is scored in full.

t starts high and is lowered until a window is full or its lower end is reached,
so a window gets exactly the rows it would get from all scores. A chunk returns
its own best rows per window; the best of all chunks are the result.

Defined cases: rows with a null id, label, vector or component, or a component
that is not finite, take no part. Rows equal in id, label and quantised vector are
one row; rows that share an id but differ are separate rows. Rows of different
dimension never meet; vectors without components score 0. A positive score of 0
admits scores of 0 only, a negative one admits nothing. Components beyond the
range of a long saturate, and so do scores; products too large for exact floats
are taken in whole numbers. Empty tables
and tables without anchors give no rows. Only ``vec_id``, ``embedding`` and
``label`` are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trafficlens.llm.tables import Scratch

ANCHOR_EVERY = 100
RELABEL_EVERY, LABELS = 7, 10
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # percent of the positive's score

GROUP = 8                # dimensions taken at once
ANCHOR_BLOCK = 64        # anchors searched at once
CHUNK_BYTES = 32 << 20   # of row vectors in one index
LEAST_ROWS = 1024        # a chunk is not cut below this for the sake of parallelism
FALL = (0.8, 0.6, 0.45, 0.3, 0.15, 0.0)  # thresholds as shares of the largest possible score
_EXACT = float(1 << 53)
_SLACK = 1.0 + 1e-9
_LONG = (1 << 63) - 1


def quantised(vectors: DataFrame) -> DataFrame:
    """``id, label, v, key`` of the rows that take part, each once."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    label = F.col("label").cast("long")
    rows = (vectors.select("vec_id", "label", "embedding")
            .where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
            .select(F.col("vec_id").cast("long").alias("id"),
                    F.when(F.col("vec_id") % RELABEL_EVERY == 0, (label + 1) % LABELS).otherwise(label).alias("label"),
                    F.transform("embedding", lambda x: F.floor(F.lit(256.0) * x.cast("double"))).alias("v")))
    return rows.withColumn("key", F.xxhash64("id", "label", "v")).distinct()


class Index:
    """The rows of one chunk and dimension, posted by dimension groups."""

    def __init__(self, ids: np.ndarray, keys: np.ndarray, labels: np.ndarray, rows: np.ndarray):
        self.ids, self.keys, self.labels, self.whole = ids, keys, labels, rows
        self.order = np.argsort(-(rows.astype(np.float64) ** 2).sum(axis=0), kind="stable")
        self.rows = rows[:, self.order].astype(np.float64)
        self.cuts = list(range(0, rows.shape[1], GROUP)) + [rows.shape[1]]
        self.rest = self.suffix_norms(self.rows)
        self.longest = float(self.rest[:, 0].max())
        self.multiplied = 0  # row groups accumulated, of all (for the tests)
        self.possible = 0

    def suffix_norms(self, x: np.ndarray) -> np.ndarray:
        """Norm of the dimensions from each cut on; 0 after the last."""
        squares = np.add.reduceat(x * x, self.cuts[:-1], axis=1) if x.shape[1] else np.zeros((len(x), 0))
        tail = np.cumsum(squares[:, ::-1], axis=1)[:, ::-1]
        return np.sqrt(np.concatenate([tail, np.zeros((len(x), 1))], axis=1))

    def search(self, anchors: np.ndarray, least: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each anchor, the rows that score ``least`` or more: (anchor, rows, scores)."""
        x = anchors[:, self.order].astype(np.float64)
        norms = self.suffix_norms(x)
        if float(norms[:, 0].max()) * self.longest >= _EXACT:
            for a, vector in enumerate(anchors):
                scores = np.array([max(-_LONG - 1, min(_LONG, s)) for s in self.whole.astype(object) @ vector.astype(object)],
                                  np.int64)
                near = np.flatnonzero(scores >= least[a])
                yield a, near, scores[near]
            return
        groups = len(self.cuts) - 1
        # Suffixes below this norm cannot bring any anchor to its threshold.
        with np.errstate(divide="ignore", invalid="ignore"):
            reach = np.where(least[:, None] > 0, least[:, None] / (norms * _SLACK), -np.inf).min(axis=0)
        posted = (self.rest[:, :groups + 1] >= reach[None, :]).sum(axis=1)  # norms fall along a row: a prefix
        posted = np.minimum(posted, groups)
        alive = np.flatnonzero((posted > 0) | (reach[0] <= self.rest[:, 0]))
        partial = np.zeros((len(x), len(alive)))
        self.possible += groups * len(self.rows)
        for k in range(groups):
            here = posted[alive] > k
            if not here.any():
                break
            a, b = self.cuts[k], self.cuts[k + 1]
            partial[:, here] += x[:, a:b] @ self.rows[alive[here], a:b].T
            self.multiplied += int(here.sum())
            done = np.minimum(posted[alive], k + 1)
            bound = partial + norms[:, done] * self.rest[alive, done][None, :] * _SLACK
            keep = (bound >= least[:, None]).any(axis=0)
            if not keep.all():
                alive, partial = alive[keep], partial[:, keep]
        done = posted[alive]
        bound = partial + norms[:, done] * self.rest[alive, done][None, :] * _SLACK
        for a in range(len(x)):
            near = np.flatnonzero(bound[a] >= least[a])
            rows = alive[near]
            scores = partial[a, near].copy()
            for k in range(groups):  # the dimensions that were left out
                late = done[near] <= k
                if late.any():
                    scores[late] += self.rows[rows[late], self.cuts[k]:self.cuts[k + 1]] @ x[a, self.cuts[k]:self.cuts[k + 1]]
            enough = scores >= least[a]
            yield a, rows[enough], scores[enough].astype(np.int64)

    def fill(self, anchors: np.ndarray, windows: list[list["Wanted"]]) -> None:
        """Lower each anchor's threshold until all its windows are full or whole."""
        tops = self.suffix_norms(anchors[:, self.order].astype(np.float64))[:, 0] * self.longest
        step = 0
        waiting = [a for a in range(len(anchors)) if any(not w.full for w in windows[a])]
        while waiting:
            least = np.array([min(w.start(tops[a], step) for w in windows[a] if not w.full) for a in waiting])
            for i, rows, scores in self.search(anchors[waiting], least):
                for w in windows[waiting[i]]:
                    if not w.full:
                        w.take(self, rows, scores, least[i])
            waiting = [a for a in waiting if any(not w.full for w in windows[a])]
            step += 1


class Wanted:
    """The best ``size`` rows of an anchor among those that ``admits`` lets in."""

    def __init__(self, size: int, low: int | None, high: int | None, admits: Callable[[Index], np.ndarray]):
        self.size, self.low, self.high, self.admits = size, low, high, admits
        self.full = False
        self.rows = np.zeros(0, np.int64)
        self.scores = np.zeros(0, np.int64)

    def start(self, top: float, step: int) -> float:
        """The threshold of a step: shares of the largest score that can be in the window."""
        if step >= len(FALL):
            return -np.inf if self.low is None else float(self.low)
        most = top if self.high is None else min(top, float(self.high))
        share = most * FALL[step]
        return share if self.low is None else max(share, float(self.low))

    def take(self, index: Index, rows: np.ndarray, scores: np.ndarray, least: float) -> None:
        ok = self.admits(index)[rows]
        if self.low is not None:
            ok &= (scores >= self.low) & (scores <= self.high)
        rows, scores = rows[ok], scores[ok]
        whole = least == -np.inf or (self.low is not None and least <= self.low)
        if len(rows) >= self.size or whole:
            best = np.lexsort((index.keys[rows], index.ids[rows], -scores))[:self.size] if len(rows) else rows
            self.rows, self.scores, self.full = rows[best], scores[best], True


def _by_dimension(batch: pa.RecordBatch | pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dimension, row numbers, matrix) of the vectors of a batch."""
    v = batch.column("v")
    v = v.combine_chunks() if isinstance(v, pa.ChunkedArray) else v
    lens = v.value_lengths().to_numpy(zero_copy_only=False)
    for d in np.unique(lens).tolist():
        rows = np.flatnonzero(lens == d)
        part = v.take(pa.array(rows))
        yield int(d), rows, part.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), int(d))


def _search_chunks(dealt: DataFrame, schema: str,
                   ask: Callable[[pa.RecordBatch, np.ndarray, Index], list[list[Wanted]]],
                   tell: Callable[[pa.RecordBatch, np.ndarray, Index, list[list[Wanted]]], pa.RecordBatch]) -> DataFrame:
    """Index the rows of every chunk (role 0), then let the anchors (role 1) pass by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, held, indexes = None, [], None
        for batch in batches:
            of, role = batch.column("chunk").to_numpy(), batch.column("role").to_numpy()
            cuts = [0, *(np.flatnonzero((of[1:] != of[:-1]) | (role[1:] != role[:-1])) + 1).tolist(), len(of)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                if of[a] != chunk:
                    chunk, held, indexes = of[a], [], None
                part = batch.slice(a, b - a)
                if role[a] == 0:
                    held.append(part)
                    continue
                if indexes is None:
                    indexes = {}
                    table = pa.Table.from_batches(held) if held else part.slice(0, 0)
                    ids, keys, labels = (table.column(c).to_numpy() for c in ("id", "key", "label"))
                    for d, rows, matrix in _by_dimension(table) if table.num_rows else ():
                        indexes[d] = Index(ids[rows], keys[rows], labels[rows], matrix)
                    held = []
                for at in range(0, part.num_rows, ANCHOR_BLOCK):
                    block = part.slice(at, ANCHOR_BLOCK)
                    for d, rows, anchors in _by_dimension(block):
                        if d in indexes:
                            windows = ask(block, rows, indexes[d])
                            indexes[d].fill(anchors, windows)
                            yield tell(block, rows, indexes[d], windows)

    return dealt.mapInArrow(run, schema)


def deal(rows: DataFrame, anchors: DataFrame, chunks: int) -> DataFrame:
    """Rows to their chunk, anchors to every chunk, a chunk's rows first. ``anchors``
    may carry its windows in ``positives``."""
    windows = "array<struct<id:bigint,key:bigint,score:bigint>>"
    own = rows.select(F.pmod("key", F.lit(chunks)).cast("int").alias("chunk"), F.lit(0).alias("role"),
                      "id", "key", "label", "v", F.lit(None).cast(windows).alias("positives"))
    past = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"), F.lit(1).alias("role"),
                          "id", "key", "label", "v", F.col("positives").cast(windows).alias("positives"))
    spark = rows.sparkSession
    parts = min(chunks, max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism))
    return own.unionByName(past).repartition(parts, "chunk").sortWithinPartitions("chunk", "role")


def positive_rows(dealt: DataFrame, size: int) -> DataFrame:
    """``anchor, akey, id, key, score``: each chunk's best rows of the anchor's label."""

    def ask(block, rows, index):
        label, key, own = (block.column(c).to_numpy()[rows] for c in ("label", "key", "id"))
        return [[Wanted(size, None, None, lambda index, y=y, k=k, i=i: (index.labels == y)
                         & ~((index.keys == k) & (index.ids == i)))] for y, k, i in zip(label, key, own, strict=True)]

    def tell(block, rows, index, windows):
        many = np.array([len(w[0].rows) for w in windows])
        found = np.concatenate([w[0].rows for w in windows])
        at = np.repeat(rows, many)
        return pa.RecordBatch.from_pydict({
            "anchor": block.column("id").take(pa.array(at)), "akey": block.column("key").take(pa.array(at)),
            "id": pa.array(index.ids[found]), "key": pa.array(index.keys[found]),
            "score": pa.array(np.concatenate([w[0].scores for w in windows]))})

    return _search_chunks(dealt, "anchor long, akey long, id long, key long, score long", ask, tell)


def negative_rows(dealt: DataFrame, size: int) -> DataFrame:
    """``anchor, akey, pid, pkey, pscore, id, key, score``: each chunk's best rows of
    every window."""

    def ask(block, rows, index):
        label, wanted = block.column("label").to_numpy()[rows], block.column("positives").take(pa.array(rows)).to_pylist()
        out = []
        for y, positives in zip(label, wanted, strict=True):
            other = lambda index, y=y: index.labels != y
            bounds = [(-(-LOW * p["score"] // 100), HIGH * p["score"] // 100) for p in positives]
            out.append([Wanted(size, low, high, other) for low, high in bounds])
            for w in out[-1]:
                w.full = w.low > w.high
        return out

    def tell(block, rows, index, windows):
        wanted = block.column("positives").take(pa.array(rows)).to_pylist()
        ids, keys = (block.column(c).to_numpy()[rows] for c in ("id", "key"))
        out = {c: [] for c in ("anchor", "akey", "pid", "pkey", "pscore", "id", "key", "score")}
        for a, k, ps, ws in zip(ids.tolist(), keys.tolist(), wanted, windows, strict=True):
            for p, w in zip(ps, ws, strict=True):
                n = len(w.rows)
                for c, v in (("anchor", a), ("akey", k), ("pid", p["id"]), ("pkey", p["key"]), ("pscore", p["score"])):
                    out[c] += [v] * n
                out["id"] += index.ids[w.rows].tolist()
                out["key"] += index.keys[w.rows].tolist()
                out["score"] += w.scores.tolist()
        return pa.RecordBatch.from_pydict({c: pa.array(v, pa.int64()) for c, v in out.items()})

    return _search_chunks(dealt, "anchor long, akey long, pid long, pkey long, pscore long, id long, key long, score long",
                          ask, tell)


def chunk_count(rows: DataFrame) -> int:
    """Chunks of at most about ``CHUNK_BYTES``, and enough for all cores."""
    n, components = rows.agg(F.count(F.lit(1)), F.sum(F.size("v"))).first()
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return max(1, -(-8 * (components or 0) // CHUNK_BYTES), min(2 * cores, n // LEAST_ROWS))


def hard_negatives(vectors: DataFrame, anchor_every: int = ANCHOR_EVERY, positives: int = POSITIVES,
                   negatives: int = NEGATIVES) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``."""
    scratch = Scratch(vectors.sparkSession, "hard-negatives")
    rows = scratch.keep(quantised(vectors), "rows")
    chunks = chunk_count(rows)
    anchors = rows.where(F.col("id") % anchor_every == 0)
    near = positive_rows(deal(rows, anchors.withColumn("positives", F.lit(None)), chunks), positives)
    first = Window.partitionBy("anchor", "akey").orderBy(F.desc("score"), "id", "key")
    best = (near.withColumn("at", F.row_number().over(first)).where(F.col("at") <= positives)
            .groupBy("anchor", "akey").agg(F.collect_list(F.struct("id", "key", "score")).alias("positives")))
    asked = scratch.keep(anchors.join(best, (F.col("id") == F.col("anchor")) & (F.col("key") == F.col("akey")))
                         .select("id", "key", "label", "v", "positives"), "asked")
    found = negative_rows(deal(rows, asked, chunks), negatives)
    first = Window.partitionBy("anchor", "akey", "pid", "pkey").orderBy(F.desc("score"), "id", "key")
    return scratch.result(
        found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= negatives)
        .select(F.col("anchor").alias("anchor_id"), F.col("pid").alias("positive_id"), "rank",
                F.col("id").alias("negative_id"), F.col("pscore").alias("positive_score"),
                F.col("score").alias("negative_score")))


def hard_negatives_sql() -> str:
    """DuckDB SQL of the query: every anchor against every row."""
    return f"""
WITH vectors AS (
    SELECT DISTINCT vec_id AS id, CASE WHEN vec_id % {RELABEL_EVERY} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label,
           [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scores AS (
    SELECT a.id AS anchor, a.label AS a_label, a.v AS a_v, b.id, b.label, b.v, list_dot_product(a.v, b.v)::BIGINT AS score
    FROM vectors a JOIN vectors b ON a.id % {ANCHOR_EVERY} = 0 AND len(a.v) = len(b.v)),
positives AS (
    SELECT anchor, a_label, a_v, id AS pid, score AS pscore FROM scores
    WHERE label = a_label AND (id <> anchor OR v <> a_v)
    QUALIFY row_number() OVER (PARTITION BY anchor, a_label, a_v ORDER BY score DESC, id) <= {POSITIVES})
SELECT p.anchor AS anchor_id, pid AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor, p.a_label, p.a_v, pid ORDER BY score DESC, id) AS INTEGER) AS rank,
       id AS negative_id, pscore AS positive_score, score AS negative_score
FROM positives p JOIN scores s ON s.anchor = p.anchor AND s.a_label = p.a_label AND s.a_v = p.a_v AND s.label <> p.a_label
 AND {LOW} * pscore <= 100 * score AND 100 * score <= {HIGH} * pscore
QUALIFY rank <= {NEGATIVES}
"""
