"""Connected components of a link table, as alternating star contractions.

Links are first contracted where they lie: a task replaces the links it holds by a
spanning forest, each node at the smallest of its tree, which keeps connectivity.
Each round then points every node's larger neighbours at its smallest one (large
star), and its smaller neighbours and itself likewise (small star); the published
two-phase algorithm ends after O(log^2 n) rounds, in practice one or two, as the
rounds contract in the tasks too. It ends when every node has one link and none to
a node that has a link itself. Minima are aggregated map-side, so a hub's links
never meet in one group; the links of a round are written to the shared folder,
which also cuts the lineage.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficlens.llm.tables import Scratch

# Links that a task contracts at once.
HELD = 1 << 20


def spanning_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, smallest node of its tree) with the connectivity of the links a - b."""
    ids, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    up = np.arange(len(ids))
    u, v = place[:len(a)], place[len(a):]
    while True:
        low, high = np.minimum(up[u], up[v]), np.maximum(up[u], up[v])
        apart = low < high
        if not apart.any():
            break
        np.minimum.at(up, high[apart], low[apart])
        while not np.array_equal(up, up[up]):
            up = up[up]
    below = np.flatnonzero(up != np.arange(len(ids)))
    return ids[below], ids[up[below]]


def contracted(links: DataFrame) -> DataFrame:
    """The spanning forests of the links of each task (a > b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def forest() -> tuple[np.ndarray, np.ndarray]:
            return spanning_forest(*(np.concatenate([h[i] for h in held]) for i in (0, 1)))

        for batch in batches:
            held.append(tuple(batch.column(c).to_numpy() for c in ("a", "b")))
            size += batch.num_rows
            if size >= HELD:
                a, b = forest()
                if len(a) > HELD // 2:  # a large forest goes as it is
                    yield pa.RecordBatch.from_pydict({"a": a, "b": b})
                    held, size = [], 0
                else:
                    held, size = [(a, b)], len(a)
        if held:
            a, b = forest()
            yield pa.RecordBatch.from_pydict({"a": a, "b": b})

    return links.where(F.col("a") != F.col("b")).select("a", "b").mapInArrow(run, "a long, b long")


def ended(links: DataFrame) -> DataFrame:
    """``id, component`` of at most ``HELD`` links, contracted in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [tuple(batch.column(c).to_numpy() for c in ("a", "b")) for batch in batches]
        if held:
            a, b = spanning_forest(*map(np.concatenate, zip(*held, strict=True)))
            roots = np.unique(b)
            yield pa.RecordBatch.from_pydict({"id": np.concatenate([a, roots]), "component": np.concatenate([b, roots])})

    return links.coalesce(1).mapInArrow(run, "id long, component long")


def _settled(links: DataFrame) -> bool:
    """No node has two links, or a link to a node that has one itself (or there are none)."""
    ends = links.select(F.col("a").alias("id"), "b").unionByName(
        links.select(F.col("b").alias("id"), F.lit(None).cast("long").alias("b")))
    open_ = (ends.groupBy("id").agg(F.min("b").alias("least"), F.max("b").alias("most"),
                                    F.bool_or(F.col("b").isNull()).alias("root"))
             .where((F.col("least") != F.col("most")) | (F.col("root") & F.col("least").isNotNull())))
    return not open_.limit(1).collect()


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``links`` (a, b: long): ``id, component`` for every id that has a link to
    another, ``component`` the smallest id reachable. Null ends and loops are left out."""
    current = scratch.keep(contracted(links), "links")
    while True:
        if current.count() <= HELD:
            return ended(current)
        if _settled(current):
            break
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = scratch.keep(contracted(large), "large")
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(down, "a").where(F.col("b") != F.col("m"))
                 .select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(down.select("a", F.col("m").alias("b"))))
        following = scratch.keep(contracted(small), "links")
        scratch.drop(large)
        scratch.drop(current)
        current = following
    current = current.distinct()
    roots = current.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots)
