"""Embedding near-duplicates: exact metric range join over pivot cells.

Vectors link when their cosine, in double precision, is at least ``threshold``;
on the unit sphere that is an angle of at most ``r``. A bounded set of pivots
splits the vectors into cells (nearest pivot). For a vector v of cell p and any
partner y of cell q the triangle inequality gives

    angle(v, q) <= angle(v, y) + angle(y, q) <= r + angle(y, p) <= 2 r + angle(v, p)
    angle(v, q) <= r + radius(q)

so v is replicated only to the cells within both bounds, and only to those with
a higher number: every pair meets in exactly one cell. Cells are dealt in chunks
of about ``CHUNK`` vectors, so a dense cell is many tasks; a chunk keeps its own
vectors and streams the replicas past them in matrix products. Chunks emit link
counts and spanning links only, never all pairs.

Equal vectors are collapsed first (with their count), so copies cost one row.
The pivots are at most ``MAX_PIVOTS`` vectors, broadcast; their number follows
the row count. Any choice of pivots gives the same links.

Defined cases: a null vector, one holding null or non-finite components, or of
length zero links with nothing (itself alone in its component), as do vectors of
different dimension; a null ``vec_id`` has a null component, is not kept and
counts for nobody. Rows that share a ``vec_id`` are one node, and each row counts
as a vector. Only ``vec_id`` and ``embedding`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficlens.llm.components import components
from trafficlens.llm.tables import Scratch

CHUNK = 2048
MAX_PIVOTS = 256
_SLACK = 1e-7  # of the replication bounds, in radians: far above rounding
_CLOSE = 1e-11  # cosines this near the threshold are taken again from the raw vectors


def vector_classes(vectors: DataFrame) -> DataFrame:
    """Usable vectors, equal ones once: ``cid`` (smallest vec_id), ``weight``, ``embedding`` (doubles)."""
    e = F.col("embedding").cast("array<double>")
    usable = (F.col("vec_id").isNotNull() & e.isNotNull() & (F.size(e) > 0)
              & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
              & F.exists(e, lambda x: x != 0.0))
    return (vectors.where(usable).groupBy(e.alias("embedding"))
            .agg(F.min(F.col("vec_id").cast("long")).alias("cid"), F.count(F.lit(1)).alias("weight")))


def of_one_id(vectors: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the classes of rows that share a ``vec_id``."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("embedding")) \
        .where(F.col("id").isNotNull() & F.col("embedding").isNotNull())
    several = (rows.groupBy("id").agg(F.min(F.xxhash64("embedding")).alias("least"), F.max(F.xxhash64("embedding")).alias("most"))
               .where(F.col("least") != F.col("most")).select("id"))
    held = rows.join(several, "id", "left_semi").join(classes.select("embedding", "cid"), "embedding").select("id", "cid").distinct()
    return held.join(held.groupBy("id").agg(F.min("cid").alias("b")), "id").select(F.col("cid").alias("a"), "b")


def _matrix(column: pa.Array, width: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of a list column padded with zeros to ``width``, and their dimensions."""
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy()
    dims = np.diff(offsets)
    width = max(int(dims.max(initial=0)), width or 0)
    if len(dims) and (dims == width).all():
        return flat[offsets[0]:offsets[-1]].reshape(-1, width), dims
    out = np.zeros((len(dims), width))
    row = np.repeat(np.arange(len(dims)), dims)
    out[row, np.arange(len(row)) - np.repeat(offsets[:-1] - offsets[0], dims)] = flat[offsets[0]:offsets[-1]]
    return out, dims


def _unit(m: np.ndarray) -> np.ndarray:
    largest = np.abs(m).max(axis=1, keepdims=True)  # keeps tiny and huge vectors from under- and overflow
    m = m / np.where(largest > 0, largest, 1.0)
    return m / np.maximum(np.sqrt((m * m).sum(axis=1, keepdims=True)), 1e-300)


def _angles(m: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    if m.shape[1] < pivots.shape[1]:
        m = np.pad(m, ((0, 0), (0, pivots.shape[1] - m.shape[1])))
    return np.arccos(np.clip(_unit(m)[:, :pivots.shape[1]] @ pivots.T, -1.0, 1.0))


def choose_pivots(classes: DataFrame, count: int) -> np.ndarray:
    """Unit pivots: the vectors with the smallest hashes, one for about two
    chunks of vectors, ``MAX_PIVOTS`` at most."""
    k = int(min(MAX_PIVOTS, max(1, -(-count // (2 * CHUNK)))))
    rows = classes.orderBy(F.xxhash64("embedding"), "cid").limit(k).select("embedding").collect()
    if not rows:
        return np.zeros((1, 1))
    return _unit(_matrix(pa.array([r["embedding"] for r in rows], pa.list_(pa.float64())))[0])


def range_links(classes: DataFrame, threshold: float, scratch: Scratch) -> DataFrame:
    """Rows (a, b, n): vectors ``a`` meets ``n`` vectors of other classes; (a, b) are
    spanning links of its component (b null: count only)."""
    spark = classes.sparkSession
    radius = float(np.arccos(threshold)) + _SLACK
    pivots = spark.sparkContext.broadcast(choose_pivots(classes, classes.count()))
    width = int(pivots.value.shape[1])
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            angles = _angles(_matrix(batch.column("embedding"), width)[0], pivots.value)
            cell = angles.argmin(axis=1)
            yield pa.RecordBatch.from_pydict({
                "cid": batch.column("cid"), "weight": batch.column("weight"), "embedding": batch.column("embedding"),
                "cell": pa.array(cell.astype(np.int64)), "angle": pa.array(angles[np.arange(len(cell)), cell])})

    homes = scratch.keep(classes.select("cid", "weight", "embedding").mapInArrow(
        home, "cid long, weight long, embedding array<double>, cell long, angle double"), "homes")
    sizes, reach = {}, {}
    for r in homes.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("r")).collect():
        sizes[r["cell"]], reach[r["cell"]] = r["n"], r["r"]  # one row a pivot
    cells = len(pivots.value)
    chunks = np.array([max(1, -(-sizes.get(c, 0) // CHUNK)) for c in range(cells)])
    first = np.concatenate(([0], np.cumsum(chunks)))
    limit = np.array([reach.get(c, -10.0) for c in range(cells)]) + radius

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each vector to its own chunk (role 0), the later chunks of its cell and those of the cells in reach (1)."""
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                cell, angle = batch.column("cell").to_numpy(), batch.column("angle").to_numpy()
                angles = _angles(_matrix(batch.column("embedding"), width)[0], pivots.value)
                near = (angles <= angle[:, None] + 2 * radius) & (angles <= limit[None, :])
                near &= np.arange(cells)[None, :] > cell[:, None]
                near[np.arange(len(cell)), cell] = True
                row, to = np.nonzero(near)
                own = first[cell] + batch.column("cid").to_numpy() % chunks[cell]
                many = chunks[to]
                row, start = np.repeat(row, many), np.repeat(first[to], many)
                target = start + np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
                keep = target >= own[row]
                row, target = row[keep], target[keep]
                for a in range(0, len(row), 8192):
                    part = pa.array(row[a:a + 8192])
                    yield pa.RecordBatch.from_pydict({
                        "chunk": pa.array(target[a:a + 8192]),
                        "role": pa.array((target[a:a + 8192] != own[row[a:a + 8192]]).astype(np.int32)),
                        "cid": batch.column("cid").take(part), "weight": batch.column("weight").take(part),
                        "embedding": batch.column("embedding").take(part)})

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: _Block | None = None
        key = None
        for batch in batches:
            chunk = batch.column("chunk").to_numpy()
            cuts = [0, *(np.flatnonzero(chunk[1:] != chunk[:-1]) + 1).tolist(), len(chunk)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                if key != chunk[a]:
                    if block is not None:
                        yield block.close()
                    key, block = chunk[a], _Block(threshold)
                part = batch.slice(a, b - a)
                roles = part.column("role").to_numpy()
                split = int((roles == 0).sum())
                if split:
                    block.add(part.slice(0, split))
                for at in range(split, b - a, 2048):
                    yield block.pass_by(part.slice(at, min(2048, b - a - at)))
        if block is not None:
            yield block.close()

    return (homes.mapInArrow(deal, "chunk long, role int, cid long, weight long, embedding array<double>")
            .repartition(min(int(first[-1]), parts), "chunk").sortWithinPartitions("chunk", "role")
            .mapInArrow(meet, "a long, b long, n long"))


class _Block:
    """One chunk: its own vectors in memory, all others passing by."""

    def __init__(self, threshold: float):
        self.threshold = threshold
        self.parts: list[pa.RecordBatch] = []
        self.ready = False

    def add(self, rows: pa.RecordBatch) -> None:
        self.parts.append(rows)

    def settle(self) -> None:
        """All own vectors are here: compare them with each other."""
        self.ready = True
        self.ids = np.concatenate([p.column("cid").to_numpy() for p in self.parts] or [np.zeros(0, np.int64)])
        self.weights = np.concatenate([p.column("weight").to_numpy() for p in self.parts] or [np.zeros(0, np.int64)])
        width = max((int(p.column("embedding").value_lengths().to_numpy().max()) for p in self.parts), default=1)
        pairs = [_matrix(p.column("embedding"), width) for p in self.parts]
        self.raw = np.concatenate([m for m, _ in pairs]) if pairs else np.zeros((0, 1))
        self.dims = np.concatenate([d for _, d in pairs]) if pairs else np.zeros(0, np.int64)
        self.unit = _unit(self.raw) if len(self.raw) else self.raw
        self.counts = np.zeros(len(self.ids), np.int64)
        self.parent = np.arange(len(self.ids))
        self.parts = []
        for a in range(0, len(self.ids), 2048):
            hit = self.links(self.raw[a:a + 2048], self.unit[a:a + 2048], self.dims[a:a + 2048])
            hit[np.arange(hit.shape[0]), a + np.arange(hit.shape[0])] = False
            self.counts[a:a + 2048] += hit @ self.weights
            hit[np.arange(hit.shape[0]), a + np.arange(hit.shape[0])] = hit.any(axis=1)
            self.join(hit)

    def links(self, raw: np.ndarray, unit: np.ndarray, dims: np.ndarray) -> np.ndarray:
        """Rows by own vectors: linked or not."""
        cos = unit @ self.unit.T
        hit = cos >= self.threshold
        for i, j in zip(*np.nonzero(np.abs(cos - self.threshold) < _CLOSE), strict=True):
            x, y = raw[i], self.raw[j]
            hit[i, j] = np.dot(x, y) / (np.sqrt(np.dot(x, x)) * np.sqrt(np.dot(y, y))) >= self.threshold
        if len(dims) and len(self.dims) and (dims.min() != self.dims.max() or dims.max() != self.dims.min()):
            hit &= dims[:, None] == self.dims[None, :]
        return hit

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, hit: np.ndarray) -> None:
        """Own vectors that one row links with are in one tree."""
        for row in hit[hit.any(axis=1)]:
            near = np.flatnonzero(row)
            roots = {self.root(int(i)) for i in np.unique(self.parent[near])}
            least = min(roots)
            for r in roots:
                self.parent[r] = least

    def pass_by(self, rows: pa.RecordBatch) -> pa.RecordBatch:
        if not self.ready:
            self.settle()
        ids, weights = rows.column("cid").to_numpy(), rows.column("weight").to_numpy()
        raw, dims = _matrix(rows.column("embedding"), self.raw.shape[1])
        if raw.shape[1] > self.raw.shape[1]:  # wider vectors link with none of these
            raw = raw[:, :self.raw.shape[1]]
        hit = self.links(raw, _unit(raw), dims) if len(self.ids) else np.zeros((len(ids), 0), bool)
        any_hit = hit.any(axis=1)
        self.counts += weights @ hit
        self.join(hit)
        near = hit[any_hit].argmax(axis=1) if any_hit.any() else np.zeros(0, np.int64)
        return _links(ids[any_hit], self.ids[near] if len(near) else near, hit[any_hit] @ self.weights)

    def close(self) -> pa.RecordBatch:
        if not self.ready:
            self.settle()
        seen = np.flatnonzero(self.counts)
        return _links(self.ids[seen], self.ids[[self.root(int(i)) for i in seen]] if len(seen) else seen,
                      self.counts[seen])


def _links(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({k: pa.array(np.asarray(v).astype(np.int64)) for k, v in
                                       (("a", a), ("b", b), ("n", n))})


def embedding_join(vectors: DataFrame, threshold: float = 0.95) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` for every row."""
    vectors = vectors.select("vec_id", "embedding")
    scratch = Scratch(vectors.sparkSession, "embedding-join")
    classes = scratch.keep(vector_classes(vectors), "classes")
    found = scratch.keep(range_links(classes, threshold, scratch), "found")
    labels = components(found.select("a", "b").where(F.col("b").isNotNull()).unionByName(of_one_id(vectors, classes)), scratch)
    others = found.groupBy(F.col("a").alias("cid")).agg(F.sum("n").alias("others"))
    of_class = (classes.join(others, "cid", "left").join(labels.withColumnRenamed("id", "cid"), "cid", "left")
                .select("embedding", (F.col("weight") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
                        F.coalesce("component", "cid").alias("component_id")))
    ids = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    rows = (ids.join(of_class, "embedding", "left")
            .select("vec_id", F.when(F.col("vec_id").isNull(), F.lit(0)).otherwise(
                F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"),
                F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", F.col("vec_id").cast("long")))
                .alias("component_id")))
    return scratch.result(rows.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))
