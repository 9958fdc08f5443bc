"""Best-fit packing with conflicts.

Documents (long ones as full pieces and a rest) are packed into bins of
``capacity`` words. A bin carries two bitmaps, of the sources and of the
duplicate clusters it holds; an item may not join a bin that already holds its
source or its cluster. Items go in by falling length. Open bins are ordered by
what is left in them, and the search starts at the tightest that the item fits
and moves on to the next larger until one is compatible; without one a new bin
opens.

Packing runs in shards of about ``shard_items`` items, dealt by the hash of the
row, so a hot source or cluster is spread evenly and every shard is one bounded
task; the shard count follows the input. Only ids, lengths and hashed keys are
shuffled, never text.

The clusters are those of equal texts (``best_fit_packing``), of a named column,
or of near copies too (``near_copy_packing``: components of the n-gram join).

Defined cases: a document without words (or null text) takes no room and goes
to no bin (``bin_id`` null, one row); a null source or cluster conflicts with
nothing; equal lengths go in the order of ``doc_id``, then of the row's digest;
repeated rows are items of their own, equal in cluster. A document of several
pieces has one row a piece. Only ``doc_id``, ``text`` and ``source`` (and the
cluster column, if named) are read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficlens.llm import textops as tx
from trafficlens.llm.components import components
from trafficlens.llm.ngram_join import ngram_join
from trafficlens.llm.tables import Scratch, ship_package

CAPACITY = 2048
SHARD_ITEMS = 8192

# White space to spaces, A-Z to a-z.
_TO_SPACE_LOWER = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ").lower()


class Bins:
    """Open bins of one shard, ordered by residual capacity."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.open: list[tuple[int, int]] = []  # (residual, bin), ascending
        self.sources: list[int] = []           # bitmap of each bin
        self.clusters: list[int] = []

    def place(self, length: int, source: int, cluster: int) -> tuple[int, int]:
        """Bin and start of an item; ``source`` and ``cluster`` are bits (0: none)."""
        bins, sources, clusters = self.open, self.sources, self.clusters
        for at in range(bisect_left(bins, (length, -1)), len(bins)):
            residual, k = bins[at]
            if not (sources[k] & source or clusters[k] & cluster):
                del bins[at]
                self._keep(k, residual - length, source, cluster)
                return k, self.capacity - residual
        k = len(self.sources)
        self.sources.append(0)
        self.clusters.append(0)
        self._keep(k, self.capacity - length, source, cluster)
        return k, 0

    def _keep(self, k: int, residual: int, source: int, cluster: int) -> None:
        self.sources[k] |= source
        self.clusters[k] |= cluster
        if residual:
            insort(self.open, (residual, k))


def _bits(values: np.ndarray, missing: np.ndarray) -> list[int]:
    """One bit for each distinct value, 0 where it is missing. Values that occur
    once in the shard conflict with nothing and need no bit."""
    _, inverse, counts = np.unique(values, return_inverse=True, return_counts=True)
    code = np.cumsum(counts > 1) - 1
    return [0 if gone or counts[k] == 1 else 1 << int(code[k])
            for k, gone in zip(inverse.tolist(), missing, strict=True)]


def pack_shard(rows: pa.Table, capacity: int) -> np.ndarray:
    """Bin and start of each item of one shard."""
    n = rows.column("n").to_numpy()
    order = np.lexsort((rows.column("piece").to_numpy(), rows.column("digest").to_numpy(),
                        rows.column("doc_id").fill_null(-1).to_numpy(), -n))
    sources = _bits(rows.column("source").fill_null(0).to_numpy(),
                    rows.column("source").is_null().to_numpy())
    clusters = _bits(rows.column("cluster").fill_null(0).to_numpy(), rows.column("cluster").is_null().to_numpy())
    bins = Bins(capacity)
    where = np.zeros((len(n), 2), np.int64)
    for i in order.tolist():
        where[i] = bins.place(int(n[i]), sources[i], clusters[i])
    return where


def word_facts(texts: pa.Array) -> pa.StructArray:
    """``words, same`` of every text: the number of its words and a 64-bit digest of
    the lower-cased words joined by one space."""
    words, digests = [], []
    for _, _, data, offsets in tx.text_chunks(texts):
        raw = data.tobytes().translate(_TO_SPACE_LOWER)
        for a, b in pairwise(offsets.tolist()):
            text = raw[a:b]
            if not text.isascii():
                text = text.decode("utf-8", "replace").lower().encode()
            while b"  " in text:
                text = text.replace(b"  ", b" ")
            text = text.strip(b" ")
            words.append(text.count(b" ") + 1 if text else 0)
            digests.append(hashlib.blake2b(text, digest_size=8).digest())
    return pa.StructArray.from_arrays([pa.array(words, pa.int64()), pa.array(np.frombuffer(b"".join(digests), np.int64))],
                                      names=["words", "same"])


def _node() -> Column:
    """The id of a document in the n-gram join; one without ``doc_id`` goes by its text."""
    return F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text"))


def facts(docs: DataFrame, cluster: str | None = None) -> DataFrame:
    """``doc_id, node, digest, words, source, same, own`` of every row: all that packing
    takes from a text, in one pass. ``same`` is equal for texts that are equal in
    their lower-cased words; ``own`` is the hash of the cluster column, if named."""
    named = F.lit(None).cast("long") if cluster is None else F.when(F.col(cluster).isNotNull(), F.xxhash64(cluster))

    @F.arrow_udf("struct<words: long, same: long>")
    def found(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            yield word_facts(column)

    return docs.select(
        "doc_id", _node().alias("node"), F.xxhash64("text").alias("digest"),
        found(F.coalesce(F.col("text"), F.lit(""))).alias("found"),
        F.when(F.col("source").isNotNull(), F.xxhash64("source")).alias("source"), named.alias("own")) \
        .select("doc_id", "node", "digest", "found.words", "source", "found.same", "own")


def near_copies(docs: DataFrame, known: DataFrame, scratch: Scratch) -> DataFrame:
    """``node, near``: the cluster of every document. Components of the n-gram
    join, joined where their texts are equal in lower-cased words (the n-gram join
    folds A-Z only). ``known``: the kept ``facts`` of the documents."""
    groups = scratch.keep(ngram_join(docs.select(_node().alias("doc_id"), "text"))
                          .groupBy(F.col("doc_id").alias("node")).agg(F.min("component_id").alias("near")), "groups")
    same = known.where(F.col("words") > 0).select("node", "same").join(groups, "node").groupBy("same").agg(
        F.min("near").alias("b"), F.max("near").alias("most")).where(F.col("b") != F.col("most")).select("same", "b")
    links = (known.where(F.col("words") > 0).select("node", "same").join(same, "same").join(groups, "node")
             .select(F.col("near").alias("a"), "b"))
    joined = components(links, scratch).withColumnRenamed("id", "near")
    return scratch.keep(groups.join(joined, "near", "left")
                        .select("node", F.coalesce("component", "near").alias("near")), "clusters")


def items(known: DataFrame, capacity: int, cluster: str | None = None, clusters: DataFrame | None = None) -> DataFrame:
    """``doc_id, digest, piece, n, source, cluster`` from ``facts``: one row a piece
    (piece 0 is the rest; full pieces follow). Source and cluster are 64-bit hashes;
    without a cluster column or table (``near_copies``), equal texts form one."""
    rows = known.withColumn("cluster", F.col("same") if cluster is None else F.col("own"))
    if clusters is not None:
        rows = (known.join(clusters, "node", "left")
                .withColumn("cluster", F.xxhash64(F.coalesce("near", "node"))))
    full = F.floor(F.col("words") / capacity)
    pieces = F.when(F.col("words") == 0, F.array(F.lit(0).cast("long"))).otherwise(
        F.filter(F.sequence(F.lit(0).cast("long"), full), lambda k: (k > 0) | (F.col("words") % capacity > 0)))
    return (rows.withColumn("piece", F.explode(pieces))
            .withColumn("n", F.when(F.col("piece") == 0, F.col("words") % capacity).otherwise(F.lit(capacity)))
            .select("doc_id", "digest", "piece", "n", "source", "cluster"))


def best_fit_packing(docs: DataFrame, capacity: int = CAPACITY, cluster: str | None = None,
                     shard_items: int = SHARD_ITEMS) -> DataFrame:
    """``doc_id, piece, n_words, bin_id, bin_start`` for every piece of every row."""
    ship_package(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "best-fit")
    known = scratch.keep(facts(docs.select("doc_id", "text", "source", *([cluster] if cluster else [])), cluster), "facts")
    scratch.outlive()
    return _packed(known, items(known, capacity, cluster), capacity, shard_items)


def _partitions(df: DataFrame) -> int:
    """Shuffle partitions of the session: a task packs several shards one after the other."""
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def _packed(known: DataFrame, rows: DataFrame, capacity: int, shard_items: int) -> DataFrame:
    shards = max(1, -(-known.count() // shard_items))
    keyed = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", "digest", "piece"), F.lit(shards)))
    schema = "doc_id long, piece long, n_words long, bin_id long, bin_start long"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Shards of a sorted partition, one at a time."""
        held: list[pa.RecordBatch] = []
        for batch in batches:
            shard = batch.column("shard").to_numpy()
            cuts = [0, *(np.flatnonzero(shard[1:] != shard[:-1]) + 1).tolist(), len(shard)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                if held and held[0].column("shard")[0].as_py() != shard[a]:
                    yield packed(held)
                    held = []
                held.append(batch.slice(a, b - a))
        if held:
            yield packed(held)

    def packed(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts).combine_chunks()
        where = pack_shard(table, capacity)
        shard = table.column("shard").to_numpy()
        return pa.RecordBatch.from_pydict({
            "doc_id": table.column("doc_id").combine_chunks(), "piece": table.column("piece").combine_chunks(),
            "n_words": table.column("n").combine_chunks(), "bin_id": pa.array((shard << 32) + where[:, 0]),
            "bin_start": pa.array(where[:, 1])})

    filled = (keyed.where(F.col("n") > 0).withColumn("doc_id", F.col("doc_id").cast("long"))
              .repartition(min(shards, _partitions(known)), "shard").sortWithinPartitions("shard").mapInArrow(pack, schema))
    nothing = F.lit(None).cast("long")
    return filled.unionByName(rows.where(F.col("n") == 0).select(
        F.col("doc_id").cast("long").alias("doc_id"), "piece", F.col("n").alias("n_words"),
        nothing.alias("bin_id"), nothing.alias("bin_start")))


def near_copy_packing(docs: DataFrame, capacity: int = CAPACITY, shard_items: int = SHARD_ITEMS) -> DataFrame:
    """``best_fit_packing`` with near copies as clusters: no bin holds two of them."""
    scratch = Scratch(docs.sparkSession, "packing")
    docs = docs.select("doc_id", "text", "source")
    known = scratch.keep(facts(docs), "facts")
    rows = items(known, capacity, None, near_copies(docs, known, scratch))
    return scratch.result(_packed(known, scratch.keep(rows, "items"), capacity, shard_items))
