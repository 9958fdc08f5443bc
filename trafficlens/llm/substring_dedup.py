"""Substring deduplication over a compacted de Bruijn graph of words.

The edges of the graph are the windows of ``WINDOW`` consecutive words of a
document, from their first to their last words. A word goes when a window that
covers it also starts anywhere else, in the same document or another one.

1. Compaction. Every window has a seed: of the ``SEED``-word sequences in it the
   one with the least hash, the first of equals. Consecutive windows with one seed
   occurrence are compacted into a path, in the task that reads the text: about
   one path for 14 words. Equal windows have equal seeds, so windows of different
   seeds are never compared.
2. Seeds that start several paths are found by a grouping, and their paths by a
   join. Where all paths of a seed are equal, the path is nonbranching: all its
   edges recur together and it stays whole.
3. Where the paths of a seed differ, equal ones are counted. One path of each
   kind is opened into its windows, read again from the text at its source
   coordinates; windows that more than one kind has are repeated.
4. Repeated paths and windows are glued to spans per document by their source
   coordinates, and the words under the spans go.

Paths and windows are compared by BLAKE2b digests of their words in the source
(64 bits beside the 64-bit hash of the seed, so 128 in all); rolling hashes only
choose seeds. Texts are named by 128 bits of two hashes; rows with one text share
all spans. Hot paths and windows (thousands of copies) are counted with map-side
sums and joined as plain shuffles, which Spark splits.

Defined cases: a null text is empty and has no words; texts of fewer than
``WINDOW`` words lose nothing; of a text that stands in several rows every row
loses all (if it has a window); rows that share a ``doc_id``, or have none, are
documents of their own; the digest of no words is that of the empty string. Only
``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficlens.llm import textops as tx
from trafficlens.llm.ngram_join import possibly_among
from trafficlens.llm.tables import Scratch

WINDOW = 35
SEED = 8
OPENED = 1 << 16  # windows opened at a time

_STEP = np.uint64(0xD1342543DE82EF95)
_TEXT = [("k1", "long"), ("k2", "long")]  # names a text


def seeds(words: np.ndarray, window: int) -> np.ndarray:
    """For every start of ``window`` words the position of its seed (positions of
    all words of a chunk; starts whose window crosses documents mean nothing)."""
    if len(words) < window:
        return np.zeros(0, np.int64)
    size = min(SEED, window)
    h = words[:len(words) - size + 1].copy()
    for k in range(1, size):
        h = tx.mix64(h * _STEP + words[k:len(words) - size + 1 + k])
    many = window - size + 1  # seeds in a window
    at, wide = np.arange(len(h)), 1
    while wide < many:  # least of ``wide`` seeds from each position on, then of up to twice as many
        shift = min(wide, many - wide)
        left, right = at[:len(at) - shift], at[shift:]
        at = np.where(h[left] <= h[right], left, right)
        wide += shift
    return at


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The words, each followed by one space, and where each begins (words + 1)."""
    lens = ends - starts + 1
    cuts = np.concatenate(([0], np.cumsum(lens)))
    at = np.arange(int(cuts[-1])) + np.repeat(starts - cuts[:-1], lens)
    out = data[np.minimum(at, max(len(data) - 1, 0))] if len(data) else np.zeros(0, np.uint8)
    out[cuts[1:] - 1] = 32
    return out.tobytes(), cuts


def _digest(text: memoryview) -> bytes:
    return hashlib.blake2b(text, digest_size=8).digest()


class _Chunk:
    """The words of some whole texts, and their paths."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, window: int):
        starts, ends, self.firsts = tx.word_spans(data, offsets)
        self.window = window
        self.words = tx.span_hashes(data, starts, ends)
        joined, self.cuts = _joined(data, starts, ends)
        self.text = memoryview(joined)

    def slice(self, first: int, last: int) -> memoryview:
        """Words first .. last - 1, joined by one space."""
        return self.text[self.cuts[first]:self.cuts[last] - 1]

    def paths(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``doc, start, n, seed``: start by document, number of windows, hash of the seed."""
        at = seeds(self.words, self.window)
        doc = np.searchsorted(self.firsts, np.arange(len(at)), side="right") - 1
        whole = np.arange(len(at)) + self.window <= self.firsts[doc + 1]
        if not whole.any():
            return tuple(np.zeros((4, 0), np.int64))
        begins = whole.copy()
        begins[1:] &= (at[1:] != at[:-1]) | ~whole[:-1] | (doc[1:] != doc[:-1])
        first = np.flatnonzero(begins)
        run = np.cumsum(begins)[whole] - 1
        n = np.bincount(run, minlength=len(first))
        size = min(SEED, self.window)
        h = self.words[at[first]].copy()
        for k in range(1, size):
            h = tx.mix64(h * _STEP + self.words[at[first] + k])
        return doc[first], first, n, h.view(np.int64)


def path_table(docs: DataFrame, window: int) -> DataFrame:
    """``k1, k2, start, n, seed, path`` of every path: its text, first window and
    number of windows, the hash of its seed and the digest of its words."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = (batch.column(c).to_numpy() for c, _ in _TEXT)
            for first, _, data, offsets in tx.text_chunks(batch.column("text")):
                chunk = _Chunk(data, offsets, window)
                doc, start, n, seed = chunk.paths()
                cuts, text, digest = chunk.cuts, chunk.text, hashlib.blake2b
                a, b = cuts[start].tolist(), (cuts[start + n + window - 1] - 1).tolist()
                path = b"".join([digest(text[i:j], digest_size=8).digest() for i, j in zip(a, b, strict=True)])
                yield pa.RecordBatch.from_pydict({
                    "k1": pa.array(k1[first + doc]), "k2": pa.array(k2[first + doc]),
                    "start": pa.array((start - chunk.firsts[doc]).astype(np.int32)), "n": pa.array(n.astype(np.int32)),
                    "seed": pa.array(seed), "path": pa.array(np.frombuffer(path, np.int64))})

    return docs.select("k1", "k2", "text").mapInArrow(
        build, "k1 long, k2 long, start int, n int, seed long, path long")


def opened_batches(batch: pa.RecordBatch, window: int, most: int = OPENED) -> Iterator[pa.RecordBatch]:
    """The windows of the ``paths`` of each text, in batches of about ``most``, however long a text is."""
    for first, last, data, offsets in tx.text_chunks(batch.column("text")):
        chunk = _Chunk(data, offsets, window)
        lists = batch.column("paths").slice(first, last - first)
        paths = lists.flatten()
        doc = np.repeat(np.arange(last - first), pc.list_value_length(lists).to_numpy())
        begin, n, seed = (paths.field(c).to_numpy() for c in ("start", "n", "seed"))
        single = paths.field("single").to_numpy(zero_copy_only=False)
        part = np.cumsum(n, dtype=np.int64) // most
        for run in np.split(np.arange(len(n)), np.flatnonzero(part[1:] != part[:-1]) + 1):
            many = n[run]
            start = np.arange(many.sum()) + np.repeat(begin[run] - (np.cumsum(many) - many), many)
            at = start + np.repeat(chunk.firsts[doc[run]], many)
            row = first + np.repeat(doc[run], many)
            edges = b"".join([_digest(chunk.text[i:j]) for i, j in zip(
                chunk.cuts[at].tolist(), (chunk.cuts[at + window] - 1).tolist(), strict=True)])
            yield pa.RecordBatch.from_pydict({
                "k1": batch.column("k1").take(pa.array(row)), "k2": batch.column("k2").take(pa.array(row)),
                "start": pa.array(start.astype(np.int32)), "seed": pa.array(np.repeat(seed[run], many)),
                "edge": pa.array(np.frombuffer(edges, np.int64)), "single": pa.array(np.repeat(single[run], many))})


def opened_windows(docs: DataFrame, opened: DataFrame, window: int) -> DataFrame:
    """``k1, k2, start, seed, edge, single`` of every window of the opened paths, read
    from the text: ``edge`` the digest of its words."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from opened_batches(batch, window)

    lists = opened.groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "n", "seed", "single")).alias("paths"))
    near = docs.where(possibly_among(opened, "k1")).select("k1", "k2", "text")
    return near.join(lists, ["k1", "k2"]).mapInArrow(
        build, "k1 long, k2 long, start int, seed long, edge long, single boolean")


def repeated_spans(docs: DataFrame, window: int, scratch: Scratch) -> DataFrame:
    """``k1, k2, start, stop``: spans of words (stop excluded) under repeated windows."""
    paths = scratch.keep(path_table(docs, window), "paths")
    shared = scratch.keep(
        paths.groupBy("seed").agg(F.count(F.lit(1)).alias("paths"), F.min("path").alias("least"), F.max("path").alias("most"))
        .where(F.col("paths") > 1).select("seed", (F.col("least") != F.col("most")).alias("branching")), "seeds")
    found = scratch.keep(paths.where(possibly_among(shared, "seed")).join(shared, "seed"), "found")
    scratch.drop(paths)
    branching = found.where("branching")
    kinds = scratch.keep(
        branching.groupBy("seed", "path").agg(F.count(F.lit(1)).alias("copies"),
                                              F.min(F.struct("k1", "k2", "start", "n")).alias("one")), "kinds")
    # each join ends in a table of its own, so that Spark splits its hot keys
    several = scratch.keep(branching.join(kinds.where(F.col("copies") > 1).select("seed", "path"), ["seed", "path"], "left_semi")
                           .select("k1", "k2", "start", "n"), "several")
    opened = kinds.select("one.*", "seed", (F.col("copies") == 1).alias("single"))
    edges = scratch.keep(opened_windows(docs, opened, window), "edges")
    recurring = scratch.keep(edges.groupBy("seed", "edge").agg(F.count(F.lit(1)).alias("kinds"))
                             .where(F.col("kinds") > 1).select("seed", "edge"), "recurring")
    alone = scratch.keep(edges.where("single").join(recurring, ["seed", "edge"], "left_semi")
                         .select("k1", "k2", "start", F.lit(1).alias("n")), "alone")
    spans = (found.where(~F.col("branching")).select("k1", "k2", "start", "n")
             .unionByName(several).unionByName(alone))
    return (spans.groupBy("k1", "k2", "start").agg(F.max("n").alias("n"))
            .select("k1", "k2", "start", (F.col("start") + F.col("n") + (window - 1)).alias("stop")))


def _removed(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of rows with their ``spans`` (null: none)."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, sha = [], [], []
            spans = batch.column("spans")
            cuts_at = spans.offsets.to_numpy() if spans.null_count == 0 else None
            for first, last, data, offsets in tx.text_chunks(batch.column("text")):
                starts, ends, firsts = tx.word_spans(data, offsets)
                depth = np.zeros(len(starts) + 1, np.int64)
                for d in range(last - first):
                    if spans[first + d].is_valid:
                        part = spans.values.slice(*_bounds(spans, first + d, cuts_at))
                        a, b = (part.field(f).to_numpy() + firsts[d] for f in ("start", "stop"))
                        np.add.at(depth, a, 1)
                        np.add.at(depth, b, -1)
                kept = np.cumsum(depth)[:-1] == 0
                text, at = _joined(data, starts[kept], ends[kept])
                view = memoryview(text)
                rank = np.concatenate(([0], np.cumsum(kept)))[firsts]
                for d in range(last - first):
                    i, j = at[rank[d]], at[rank[d + 1]]
                    sha.append(hashlib.sha256(view[i:max(i, j - 1)]).hexdigest())
                n_words += np.diff(firsts).tolist()
                n_removed += (np.diff(firsts) - np.diff(rank)).tolist()
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "n_words": pa.array(n_words, pa.int64()),
                "n_removed": pa.array(n_removed, pa.int64()), "kept_sha256": pa.array(sha, pa.string())})

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text", "spans").mapInArrow(
        build, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string")


def _bounds(spans: pa.ListArray, row: int, cuts: np.ndarray | None) -> tuple[int, int]:
    cuts = spans.offsets.to_numpy() if cuts is None else cuts
    return int(cuts[row]), int(cuts[row + 1] - cuts[row])


def substring_dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every row."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")) \
        .withColumn("k1", F.xxhash64("text")).withColumn("k2", F.xxhash64(F.lit("text"), "text"))
    scratch = Scratch(docs.sparkSession, "substring-dedup")
    spans = scratch.keep(repeated_spans(docs, window, scratch), "spans")
    lists = scratch.keep(spans.groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "stop")).alias("spans")), "lists")
    listed = possibly_among(lists, "k1")
    touched = docs.where(listed).join(lists, ["k1", "k2"], "left")
    rest = docs.where(~listed).withColumn("spans", F.lit(None).cast("array<struct<start:int,stop:int>>"))
    return scratch.result(_removed(touched).unionByName(_removed(rest)))


def substring_dedup_sql() -> str:
    """DuckDB SQL of the query."""
    last = WINDOW - 1
    return f"""
WITH docs AS (SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
              FROM documents),
words AS (SELECT id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM docs),
starts AS (SELECT id, w, unnest(generate_series(1, len(w) - {last})) AS pos FROM docs WHERE len(w) >= {WINDOW}),
windows AS (SELECT id, pos, md5(array_to_string(w[pos:pos + {last}], ' ')) AS d FROM starts),
hits AS (SELECT id, pos FROM windows QUALIFY count(*) OVER (PARTITION BY d) > 1),
covered AS (SELECT w.id, w.pos, w.word,
                   max(h.pos) OVER (PARTITION BY w.id ORDER BY w.pos ROWS BETWEEN {last} PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
            FROM words w LEFT JOIN hits h USING (id, pos)),
left_over AS (SELECT id, count(*) FILTER (gone) AS n_removed,
                     string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone) AS kept FROM covered GROUP BY id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN left_over USING (id)
"""
