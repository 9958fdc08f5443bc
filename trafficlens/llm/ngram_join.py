"""N-gram Jaccard join: blocked sparse product of documents by shingles.

A document is the set of its distinct five-word shingles (A-Z lower-cased; a
shorter text is one shingle). Two documents link when
``100 * |intersection| >= 80 * |union|``. The product of the document-by-shingle
incidence with its transpose is taken in blocks, and bounds from the set sizes
discard pairs before their full overlap is counted:

1. Equal sets are one class; its smallest ``doc_id`` stands for it.
2. All shingles have one global order, rare ones first (a fixed-size count
   sketch over every text tells rare from common; any order gives the same
   links). A pair over the threshold shares a shingle within the first
   ``n // 5 + 1`` of both sets, so only these enter the product, keyed by shingle.
3. In a shingle's column every document is first paired with the smallest set
   of the column only, keeping for each document the leader with the most shared
   entries. Verified pairs give components, so a group of thousands of near
   copies costs one pair a document.
4. What is left is exact: columns that still hold several components. In columns
   of up to ``SMALL_COLUMN`` entries the documents outside the largest component
   meet the others, overlap counts are summed over the columns, and pairs whose
   sizes and count bound the overlap below the threshold are dropped. Larger
   columns are multiplied in blocks of ``COLUMN_BLOCK`` by ``COLUMN_BLOCK`` entries: bitmaps of the
   whole sets (about four bits a shingle) bound each overlap from above, and a
   pair is taken up only in the first large column that both have. There every
   document is first verified against its best bounded partner, which merges most
   components, then against all that the bounds still admit.
5. Pairs are verified on whole sets, in blocks of one row document with up to
   ``BLOCK`` others.

No link between different texts is lost. Shingles are 64-bit hashes; sets are
compared as 128-bit sums for equality. Broadcast data has a fixed size (sketch
and id bitmap). Defined cases: null text, or one without words: an empty set,
linked with nothing, its own component; a null ``doc_id`` links with nothing and
has a null component; rows that share a ``doc_id`` are one node. Only ``doc_id``
and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficlens.llm import textops as tx
from trafficlens.llm.components import components
from trafficlens.llm.tables import Scratch

PERCENT = 80
SIZE = 5
SKETCH_BITS = 22
SKETCH_PARTS = 32
SKETCH_FAN_IN = 256
MAP_BITS = 23
BLOCK = 256
SMALL_COLUMN = 128
COLUMN_BLOCK = 4096
CHUNK_BYTES = 1 << 18  # of text hashed in one go: the working arrays stay in a core's cache
BUCKET_ENTRIES = 8192  # incidence entries of a bucket of shingles, about
HELD_ENTRIES = 1 << 20  # most incidence entries that a task holds at once
MIN_SIGNATURE, MAX_SIGNATURE = 256, 8192  # bits

_SKETCH_SHIFT = np.uint64(64 - SKETCH_BITS)
_OTHER = np.uint64(0xA5A5A5A55A5A5A5A)


def chunk_sets(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted distinct shingle hashes of the texts of a column, a chunk of texts at
    a time: the hashes one text after the other, and their offsets by text."""
    for first, last, data, offsets in tx.text_chunks(column, CHUNK_BYTES):
        flat, cuts = tx.document_shingles(data, offsets, SIZE)
        for d in range(last - first):
            flat[cuts[d]:cuts[d + 1]].sort()
        kept = np.ones(len(flat), bool)
        kept[1:] = flat[1:] != flat[:-1]
        kept[cuts[:-1][cuts[:-1] < cuts[1:]]] = True
        yield flat[kept], np.concatenate(([0], np.cumsum(kept)))[cuts]


def document_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text of a column."""
    for flat, cuts in chunk_sets(column):
        for a, b in pairwise(cuts.tolist()):
            yield flat[a:b]


def rarity_classes(docs: DataFrame) -> np.ndarray:
    """For every sketch slot the bit length of its shingle count, over all texts.

    Tasks count their own texts, a slot at most 255 times; a part of the sketch is
    summed over ``SKETCH_FAN_IN`` tasks first, so their number never meets in one task."""
    schema = "part int, salt int, counts binary"
    width = (1 << SKETCH_BITS) // SKETCH_PARTS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SKETCH_BITS, np.uint8)
        for batch in batches:
            for _, _, data, offsets in tx.text_chunks(batch.column("text"), CHUNK_BYTES):
                flat, _ = tx.document_shingles(data, offsets, SIZE)
                slot, n = np.unique((flat >> _SKETCH_SHIFT).astype(np.int32), return_counts=True)
                total[slot] = np.minimum(total[slot].astype(np.int64) + n, 255)
        salt = TaskContext.get().partitionId()
        if total.any():
            yield from sketch_rows({k: total[k * width:(k + 1) * width] for k in range(SKETCH_PARTS)}, salt)

    def sketch_rows(parts: dict[int, np.ndarray], salt: int) -> Iterator[pa.RecordBatch]:
        for part, counts in parts.items():
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "salt": pa.array([salt // SKETCH_FAN_IN], pa.int32()),
                "counts": pa.array([counts.tobytes()], pa.binary())})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for part, salt, counts in zip(*(batch.column(c) for c in ("part", "salt", "counts")), strict=True):
                raw = counts.as_py()
                one = np.frombuffer(raw, np.uint8 if len(raw) == width else np.uint32)
                key = (part.as_py(), salt.as_py())
                totals[key] = totals[key] + one if key in totals else one.astype(np.uint32)
        for (part, salt), total in totals.items():
            yield from sketch_rows({part: total}, salt)

    sums = docs.select("text").mapInArrow(count, schema).repartition("part", "salt").mapInArrow(add, schema)

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column("part").to_pylist(), batch.column("counts"), strict=True):
                raw = counts.as_py()
                one = np.frombuffer(raw, np.uint8 if len(raw) == width else np.uint32).astype(np.float64)
                totals[part] = totals[part] + one if part in totals else one
        for part, total in totals.items():
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()),
                                              "bits": pa.array([np.frexp(total)[1].astype(np.uint8).tobytes()])})

    out = np.zeros(1 << SKETCH_BITS, np.uint8)
    for r in sums.repartition(SKETCH_PARTS, "part").mapInArrow(lengths, "part int, bits binary").collect():  # 4 MB in all
        out[r["part"] * width:(r["part"] + 1) * width] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out


def signature(mixed: np.ndarray) -> bytes:
    """Bitmap of a set, by the low bits of its mixed hashes: a power of two of about
    four bits a shingle. Halves laid over each other give the next smaller bitmap."""
    bits = min(MAX_SIGNATURE, max(MIN_SIGNATURE, 1 << int(4 * max(len(mixed), 1) - 1).bit_length()))
    out = np.zeros(bits, np.uint8)
    out[(mixed & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(out, bitorder="little").tobytes()


def _sums(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Sums by text, modulo 2^64."""
    return np.diff(np.concatenate((np.zeros(1, np.uint64), np.cumsum(values)))[cuts]).view(np.int64)


def prefix_table(docs: DataFrame, classes: np.ndarray) -> DataFrame:
    """``doc_id, n, fp1, fp2, signature, prefix`` of every row: set size, set
    fingerprint, bitmap, prefix (64-bit shingle hashes one after the other)."""
    shared = docs.sparkSession.sparkContext.broadcast(classes)
    ids = dict(docs.dtypes)["doc_id"]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = shared.value
        for batch in batches:
            n, fp1, fp2, marks, prefix = [], [], [], [], []
            for flat, cuts in chunk_sets(batch.column("text")):
                mixed, of = tx.mix64(flat), rank[flat >> _SKETCH_SHIFT]
                n.append(np.diff(cuts))
                fp1.append(_sums(mixed, cuts))
                fp2.append(_sums(tx.mix64(flat ^ _OTHER), cuts))
                for a, b in pairwise(cuts.tolist()):
                    first = np.argsort(of[a:b], kind="stable")[:(b - a) // 5 + 1]
                    prefix.append(flat[a:b][first].tobytes())
                    marks.append(signature(mixed[a:b]) if b > a else b"")
            whole = lambda parts: pa.array(np.concatenate([np.zeros(0, np.int64), *parts]))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "n": whole(n), "fp1": whole(fp1), "fp2": whole(fp2),
                "signature": pa.array(marks, pa.binary()), "prefix": pa.array(prefix, pa.binary())})

    return docs.mapInArrow(build, f"doc_id {ids}, n long, fp1 long, fp2 long, signature binary, prefix binary")


def _byte_runs(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """64-bit values as one binary a run."""
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer((cuts * 8).astype(np.int32)),
                                                              pa.py_buffer(values)])


def column_leaders(gram: np.ndarray, n: np.ndarray, doc: np.ndarray, known: np.ndarray
                   ) -> tuple[pa.RecordBatch, np.ndarray, np.ndarray]:
    """The entries of columns with several documents, each with the column's leader.
    A ``known`` entry is the leader of a column that was written before, and is not
    written again. Also the places of these leaders and of the entries that are alone
    in their column."""
    order = np.argsort(gram)
    several = np.zeros(len(order) + 1, bool)
    several[1:-1] = gram[order[1:]] == gram[order[:-1]]
    several = several[1:] | several[:-1]
    rows, alone = order[several], order[~several]
    rows = rows[np.lexsort((doc[rows], n[rows], ~known[rows], gram[rows]))]
    begins = np.ones(len(rows), bool)
    begins[1:] = gram[rows[1:]] != gram[rows[:-1]]
    heads = rows[begins]
    leader = heads[np.cumsum(begins) - 1]
    new = ~known[rows]
    rows, leader = rows[new], leader[new]
    return pa.RecordBatch.from_pydict({
        "gram": pa.array(gram[rows]), "doc_id": pa.array(doc[rows]), "n": pa.array(n[rows]),
        "leader": pa.array(doc[leader]), "leader_n": pa.array(n[leader])}), heads, alone


def shared_columns(reps: DataFrame, bits: int) -> DataFrame:
    """The incidence entries of columns with several documents, each with the
    column's leader (smallest set, then smallest id). One shuffle by bucket (the
    first ``bits`` bits of a shingle): a batch sends its entries of a bucket as one
    row. A task takes whole buckets; of one with over ``HELD_ENTRIES`` entries it
    keeps an entry a column and writes the others, so the leader of such a column is
    the smallest of its first ones."""
    schema = "gram long, doc_id long, n long, leader long, leader_n long"

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = TaskContext.get().partitionId() << 32
        for batch in batches:
            prefix = batch.column("prefix").to_pylist()
            size = np.array([len(p) // 8 for p in prefix], np.int64)
            gram = np.frombuffer(b"".join(prefix), np.uint64)
            order = np.argsort(gram)
            gram = gram[order]
            bucket = (gram >> np.uint64(64 - bits)).astype(np.int64)
            cuts = np.concatenate(([0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [len(gram)]))
            if not len(gram):
                continue
            row = np.repeat(np.arange(len(size)), size)[order]
            yield pa.RecordBatch.from_pydict({
                "bucket": pa.array(bucket[cuts[:-1]]), "salt": pa.array(np.full(len(cuts) - 1, salt)),
                "grams": _byte_runs(gram, cuts), "sizes": _byte_runs(batch.column("n").to_numpy()[row], cuts),
                "ids": _byte_runs(batch.column("doc_id").to_numpy()[row], cuts)})
            salt += 1

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []  # gram, n, doc_id, known
        size, least, open_ = 0, HELD_ENTRIES // 8, None
        for batch in batches:
            columns = [batch.column(c) for c in ("grams", "sizes", "ids")]
            for i, bucket in enumerate(batch.column("bucket").to_pylist()):
                if held and size >= (least if bucket != open_ else HELD_ENTRIES):
                    rows = [np.concatenate(c) for c in zip(*held, strict=True)]
                    out, heads, alone = column_leaders(*rows)
                    held, size = [], 0
                    if bucket == open_:
                        rows[3][heads] = True
                        held = [tuple(c[np.concatenate([heads, alone])] for c in rows)]
                        size = min(len(held[0][0]), HELD_ENTRIES // 2)
                    yield out
                entries = [np.frombuffer(c[i].as_buffer(), np.int64) for c in columns]
                held.append((*entries, np.zeros(len(entries[0]), bool)))
                size += len(entries[0])
                open_ = bucket
        if held:
            yield column_leaders(*(np.concatenate(c) for c in zip(*held, strict=True)))[0]

    return (reps.select(F.col("doc_id").cast("long"), "n", "prefix")
            .mapInArrow(deal, "bucket long, salt long, grams binary, sizes binary, ids binary")
            .repartition("bucket").sortWithinPartitions("bucket", "salt").mapInArrow(lead, schema))


def _slot(column: str):
    return F.pmod(F.xxhash64(F.col(column).cast("long")), F.lit(1 << MAP_BITS))


def id_bitmap(ids: DataFrame, column: str) -> np.ndarray:
    """Fixed-size bitmap of hashed ids (2^MAP_BITS slots, packed: 1 MB): a scan keeps
    what it may need. With over about 2^MAP_BITS ids it lets most rows through."""
    words = (ids.select(_slot(column).alias("slot"))
             .groupBy((F.col("slot") / 64).cast("int").alias("word"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(slot % 64 as int)))").alias("bits")))
    found = words.toArrow()
    bitmap = np.zeros(1 << (MAP_BITS - 6), np.int64)
    bitmap[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return bitmap.view(np.uint8)


def in_bitmap(bitmap: np.ndarray, slot: np.ndarray) -> np.ndarray:
    return (bitmap[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1


def possibly_among(ids: DataFrame, column: str):
    """Condition on ``column`` that holds for every id of ``ids`` and, by hash
    collisions in the bitmap, for few others; null ids are not among any."""
    shared = ids.sparkSession.sparkContext.broadcast(id_bitmap(ids, column))

    @F.arrow_udf("boolean")
    def marked(slots: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for slot in slots:
            yield pa.array(in_bitmap(shared.value, slot.to_numpy(zero_copy_only=False)))

    return F.col(column).isNotNull() & marked(_slot(column))


def verify(docs: DataFrame, pairs: DataFrame, scratch: Scratch) -> DataFrame:
    """The pairs (x, y) whose whole sets meet the threshold, as links (a, b)."""
    per_x = pairs.groupBy("x").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    keyed = pairs.join(per_x, "x").withColumn("block", F.pmod(F.xxhash64("y"), "blocks"))
    wanted = (keyed.select(F.col("y").alias("id"), "x", "block", F.lit(1).alias("role"))
              .unionByName(per_x.select(F.col("x").alias("id"), "x",
                                        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
                                        F.lit(0).alias("role"))))
    wanted = scratch.keep(wanted, "wanted")
    shared = docs.sparkSession.sparkContext.broadcast(id_bitmap(wanted, "id"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = batch.column("slot").fill_null(0).to_numpy()
            chosen = pa.array(in_bitmap(shared.value, slot) & pc.is_valid(batch.column("id"))
                              .to_numpy(zero_copy_only=False))
            batch = batch.filter(chosen)
            grams = [h.tobytes() for h in document_sets(batch.column("text"))]
            yield pa.RecordBatch.from_pydict({"id": batch.column("id"), "grams": pa.array(grams, pa.binary())})

    held = docs.select(F.col("doc_id").cast("long").alias("id"), _slot("doc_id").alias("slot"), "text") \
        .mapInArrow(sets, "id long, grams binary")

    def overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, heads = None, []
        for batch in batches:
            x, block, role = (batch.column(c).to_numpy() for c in ("x", "block", "role"))
            ids, grams = batch.column("id").to_numpy(), batch.column("grams")
            cuts = np.flatnonzero((x[1:] != x[:-1]) | (block[1:] != block[:-1])) + 1
            a, b = [], []
            for part in np.split(np.arange(len(x)), cuts):
                if not len(part):
                    continue
                if key != (x[part[0]], block[part[0]]):
                    key, heads = (x[part[0]], block[part[0]]), []
                heads += [np.frombuffer(grams[int(i)].as_py(), np.uint64) for i in part[role[part] == 0]]
                others = part[role[part] == 1]
                sets_y = [np.frombuffer(grams[int(i)].as_py(), np.uint64) for i in others]
                sizes = np.array([len(s) for s in sets_y])
                if not len(sizes) or not sizes.all():
                    others, sets_y, sizes = others[sizes > 0], [s for s in sets_y if len(s)], sizes[sizes > 0]
                if not len(sizes):
                    continue
                flat = np.concatenate(sets_y)
                starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
                for head in heads:
                    if not len(head):
                        continue
                    at = np.minimum(np.searchsorted(head, flat), len(head) - 1)
                    both = np.add.reduceat((head[at] == flat).astype(np.int64), starts)
                    linked = 100 * both >= PERCENT * (len(head) + sizes - both)
                    a += [key[0]] * int(linked.sum())
                    b += ids[others[linked]].tolist()
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    blocks = (held.join(wanted, "id").select("x", "block", "role", "id", "grams")
              .repartition("x", "block").sortWithinPartitions("x", "block", "role"))
    links = scratch.keep(blocks.mapInArrow(overlaps, "a long, b long"), "verified")
    scratch.drop(wanted)
    return links


def needed_prefix_overlap(n: str, m: str):
    """Prefix entries that sets of sizes ``n`` and ``m`` share at least when they
    link: the whole overlap less what lies behind the longer remainder."""
    whole = F.ceil((F.col(n) + F.col(m)) * PERCENT / F.lit(100.0 + PERCENT))
    behind = lambda c: F.col(c) - F.floor(F.col(c) / 5) - 1
    return F.greatest(whole - F.greatest(behind(n), behind(m)), F.lit(1))


def leading_pairs(entries: DataFrame) -> DataFrame:
    """Every document with the column leader it shares most entries with (x, y).
    Leaders that share under a quarter of what a link needs are passed over: what
    they would link is found by the exact steps."""
    return (entries.where((F.col("doc_id") != F.col("leader")) & (F.col("leader_n") * 100 >= F.col("n") * PERCENT))
            .groupBy("doc_id", "leader", "n", "leader_n").agg(F.count(F.lit(1)).alias("shared"))
            .where(F.col("shared") * 4 >= needed_prefix_overlap("n", "leader_n"))
            .groupBy("doc_id").agg(F.max_by("leader", F.struct("shared", -F.col("leader"))).alias("x"))
            .select("x", F.col("doc_id").alias("y")))


def mixed_entries(entries: DataFrame, labels: DataFrame) -> DataFrame:
    """The entries of columns that hold several components: ``gram, doc_id, n,
    component, main, main_size, size`` (``main``: the column's largest component)."""
    own = (entries.join(labels.withColumnRenamed("id", "doc_id"), "doc_id", "left")
           .select("gram", "doc_id", "n", F.coalesce("component", "doc_id").alias("component")))
    columns = (own.groupBy("gram", "component").agg(F.count(F.lit(1)).alias("members"))
               .groupBy("gram").agg(F.count(F.lit(1)).alias("k"), F.sum("members").alias("size"),
                                    F.max("members").alias("main_size"),
                                    F.max_by("component", F.struct("members", "component")).alias("main"))
               .where(F.col("k") > 1).select("gram", "main", "main_size", "size"))
    return own.join(columns, "gram")


def counted_pairs(mixed: DataFrame) -> DataFrame:
    """Pairs (x, y) of different components in small columns whose sizes and shared
    entries admit the threshold."""
    small = mixed.where(F.col("size") <= SMALL_COLUMN)
    a = small.where(F.col("component") != F.col("main")).select(
        "gram", F.col("doc_id").alias("p"), F.col("n").alias("pn"), F.col("component").alias("pc"))
    b = small.select("gram", "main", F.col("doc_id").alias("q"), F.col("n").alias("qn"), F.col("component").alias("qc"))
    met = a.join(b, "gram").where(
        (F.col("pc") != F.col("qc")) & ((F.col("qc") == F.col("main")) | (F.col("p") < F.col("q")))
        & (F.least("pn", "qn") * 100 >= F.greatest("pn", "qn") * PERCENT))
    return (met.groupBy(F.least("p", "q").alias("x"), F.greatest("p", "q").alias("y"),
                        F.least("pn", "qn").alias("n"), F.greatest("pn", "qn").alias("m"))
            .agg(F.count(F.lit(1)).alias("shared"))
            .where(F.col("shared") >= needed_prefix_overlap("n", "m")).select("x", "y"))


def large_columns(mixed: DataFrame, signatures: DataFrame) -> DataFrame:
    """The entries of large mixed columns with the document's bitmap and all its
    large columns, dealt to blocks (gram, row, col) of at most about twice
    ``COLUMN_BLOCK`` entries: on the right every entry, on the left those outside
    the column's largest component, each side against all parts of the other."""
    large = mixed.where(F.col("size") > SMALL_COLUMN)
    each = large.groupBy("doc_id").agg(F.collect_list("gram").alias("columns")).join(signatures, "doc_id")
    cols, rows = (F.ceil(c / COLUMN_BLOCK) for c in (F.col("size"), F.col("size") - F.col("main_size")))
    parts = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    place = F.xxhash64("doc_id")
    right = F.transform(parts(rows), lambda r: F.struct(r.alias("row"), F.pmod(place, cols).alias("col"),
                                                        F.lit(False).alias("left")))
    left = F.transform(parts(cols), lambda c: F.struct(F.pmod(place, rows).alias("row"), c.alias("col"),
                                                       F.lit(True).alias("left")))
    dealt = F.when(F.col("component") == F.col("main"), right).otherwise(F.concat(right, left))
    return (large.withColumn("to", F.explode(dealt)).join(each, "doc_id")
            .select("gram", "to.row", "to.col", "to.left", "doc_id", "n", "component", "main", "signature", "columns"))


def _earlier(columns: pa.Array, gram: int) -> np.ndarray:
    """Documents by large columns that come before ``gram`` (0 or 1)."""
    offsets = columns.offsets.to_numpy()
    flat = columns.values.to_numpy()[offsets[0]:offsets[-1]]
    row = np.repeat(np.arange(len(columns)), np.diff(offsets))
    before = flat < gram
    kinds, place = np.unique(flat[before], return_inverse=True)
    out = np.zeros((len(columns), len(kinds)), np.float32)
    out[row[before], place] = 1.0
    return out


def _folded(rows: pa.Array, bits: int) -> np.ndarray:
    """Bitmaps of one width as words, folded to ``bits``."""
    words = np.frombuffer(b"".join(rows.to_pylist()), np.uint64).reshape(len(rows), -1)
    while words.shape[1] * 64 > bits:
        half = words.shape[1] // 2
        words = words[:, :half] | words[:, half:]
    return words


def bounded_pairs(large: DataFrame, best_only: bool) -> DataFrame:
    """Pairs (x, y) of different components in a block whose sizes and bitmaps
    admit the threshold: all, each in the first column that both have, or for
    each x outside the main component the one with the highest bound (two that
    have each other as the best come twice)."""

    def meet(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        doc, n, part = (rows.column(c).to_numpy() for c in ("doc_id", "n", "component"))
        is_left = rows.column("left").to_numpy()
        outside = part != rows.column("main").to_numpy()
        marks = rows.column("signature").combine_chunks()
        before = None if best_only else _earlier(rows.column("columns").combine_chunks(), rows.column("gram")[0].as_py())
        bits = np.array([len(x) * 8 for x in marks.to_pylist()])
        found = []
        for wide in np.unique(bits):
            for other in (wide // 2, wide, wide * 2):
                left, right = np.flatnonzero(is_left & (bits == wide)), np.flatnonzero(~is_left & (bits == other))
                if not len(left) or not len(right):
                    continue
                least = int(min(wide, other))
                a_all, b = _folded(marks.take(pa.array(left)), least), _folded(marks.take(pa.array(right)), least)
                step = max(1, (4 << 20) // max(1, b.size))
                for at in range(0, len(left), step):
                    i = left[at:at + step]
                    a = a_all[at:at + step]
                    sizes = n[i][:, None] + n[right][None, :]
                    only_a = np.bitwise_count(a[:, None, :] & ~b[None, :, :]).sum(axis=2, dtype=np.int64)
                    only_b = np.bitwise_count(b[None, :, :] & ~a[:, None, :]).sum(axis=2, dtype=np.int64)
                    most = np.minimum(n[i][:, None] - only_a, n[right][None, :] - only_b)
                    fits = ((most * (100 + PERCENT) >= sizes * PERCENT) & (part[i][:, None] != part[right][None, :]))
                    if not best_only:  # two outsiders meet once
                        fits &= ~outside[right][None, :] | (doc[i][:, None] < doc[right][None, :])
                        if fits.any():
                            fits &= (before[i] @ before[right].T) == 0
                    p, q = np.nonzero(fits)
                    bound = most[p, q] * 1_000_000 // np.maximum(sizes[p, q] - most[p, q], 1)
                    if best_only and len(p):
                        order = np.lexsort((doc[right[q]], -bound, p))
                        order = order[np.concatenate(([True], p[order][1:] != p[order][:-1]))]
                        p, q, bound = p[order], q[order], bound[order]
                    found.append((doc[i[p]], doc[right[q]], bound))
        if not found:
            return tuple(np.zeros((3, 0), np.int64))
        return tuple(np.concatenate(c) for c in zip(*found, strict=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        key = None
        out: list[tuple] = []

        def close() -> None:
            rows = pa.Table.from_batches(held)
            if rows.num_rows > 1:
                out.append(meet(rows))

        def written() -> pa.RecordBatch:
            cols = [np.concatenate(c) for c in zip(*out, strict=True)] if out else np.zeros((3, 0), np.int64)
            out.clear()
            return pa.RecordBatch.from_pydict({k: pa.array(c.astype(np.int64))
                                               for k, c in zip(("x", "y", "bound"), cols, strict=True)})

        for batch in batches:
            ids = np.stack([batch.column(c).to_numpy() for c in ("gram", "row", "col")], axis=1)
            cuts = np.flatnonzero((ids[1:] != ids[:-1]).any(axis=1)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ids)], strict=True):
                if a == b:
                    continue
                if held and key != tuple(ids[a]):
                    close()
                    held = []
                key = tuple(ids[a])
                held.append(batch.slice(a, b - a))
            yield written()
        if held:
            close()
            yield written()

    met = (large.repartition("gram", "row", "col").sortWithinPartitions("gram", "row", "col")
           .mapInArrow(run, "x long, y long, bound long"))
    if best_only:
        return (met.groupBy("x").agg(F.max_by("y", F.struct("bound", -F.col("y"))).alias("y"))
                .select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")))
    return met.select("x", "y").distinct()


def of_one_id(heads: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the class representatives of rows that share a ``doc_id``."""
    sets = F.struct("n", "fp1", "fp2")
    several = (heads.groupBy("doc_id").agg(F.min(sets).alias("least"), F.max(sets).alias("most"))
               .where(F.col("least") != F.col("most")).select("doc_id"))
    reps = (heads.select("doc_id", "n", "fp1", "fp2").join(several, "doc_id", "left_semi")
            .join(classes, ["n", "fp1", "fp2"]).select("doc_id", "rep").distinct())
    first = reps.groupBy("doc_id").agg(F.min("rep").alias("b"))
    return reps.join(first, "doc_id").select(F.col("rep").alias("a"), "b")


def ngram_join(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` for every row."""
    docs = docs.select("doc_id", "text")
    scratch = Scratch(docs.sparkSession, "ngram-join")
    table = scratch.keep(prefix_table(docs, rarity_classes(docs)), "prefixes")
    heads = table.where(F.col("doc_id").isNotNull() & (F.col("n") > 0)) \
        .withColumn("doc_id", F.col("doc_id").cast("long"))
    classes = scratch.keep(heads.groupBy("n", "fp1", "fp2").agg(F.min("doc_id").alias("rep")), "classes")
    reps = heads.join(classes.select(F.col("rep").alias("doc_id")).distinct(), "doc_id")
    total = heads.agg(F.sum(F.floor(F.col("n") / 5) + 1)).first()[0] or 0
    bits = max(1, (total // BUCKET_ENTRIES).bit_length())
    entries = scratch.keep(shared_columns(reps, bits), "entries")
    pairs = scratch.keep(leading_pairs(entries), "leading")
    labels = components(verify(docs, pairs, scratch).unionByName(of_one_id(heads, classes)), scratch)
    labels = scratch.keep(labels, "labels")
    signatures = heads.select("doc_id", "signature")
    for best_only in (True, False):
        mixed = scratch.keep(mixed_entries(entries, labels), "mixed")
        pairs = bounded_pairs(large_columns(mixed, signatures), best_only)
        if best_only:  # small columns are settled in the first of the two rounds
            pairs = pairs.unionByName(counted_pairs(mixed))
        pairs = scratch.keep(pairs.distinct() if best_only else pairs, "pairs")
        if best_only:  # a column of one component stays one: the second round reads the large columns left
            entries = scratch.keep(mixed.where(F.col("size") > SMALL_COLUMN).select("gram", "doc_id", "n"), "large")
        scratch.drop(mixed)
        if not pairs.limit(1).collect():
            continue
        links = verify(docs, pairs, scratch)
        if links.limit(1).collect():
            known = labels.select(F.col("id").alias("a"), F.col("component").alias("b"))
            labels = scratch.keep(components(known.unionByName(links), scratch), "labels")
    members = table.select("doc_id", "n", "fp1", "fp2").join(classes, ["n", "fp1", "fp2"], "left")
    out = (members.join(labels.withColumnRenamed("id", "rep"), "rep", "left")
           .select("doc_id", F.col("n").alias("n_shingles"),
                   F.when(F.col("doc_id").isNotNull(),
                          F.coalesce("component", "rep", F.col("doc_id").cast("long"))).alias("component_id")))
    return scratch.result(out)
