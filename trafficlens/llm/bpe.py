"""BPE encoding and decoding by a pair occurrence index.

The new words of a batch are laid out as one symbol array with links to the
neighbours. An index maps every mergeable pair, by its rank, to all positions
where it occurs; the active ranks are applied in ascending order, each to all
its positions at once, and only the two pairs around a merge are indexed anew.
Words met before in the same Python worker come from a bounded cache.

The vocabulary is read once on the driver from the tokenizer file (its path is
a parameter) and broadcast: its size is that of the vocabulary, not of the data.
Every task encodes its own rows; nothing is shuffled.

Defined cases: a null text encodes as the empty text (no tokens); added tokens
in a text are split off first, as the tokenizer file says; ids without an entry
decode to nothing; bytes that are not UTF-8 decode to replacement characters;
repeated rows get equal results. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficlens.llm.tables import ship_package
from trafficlens.llm.textops import text_chunks

# Words as the byte-level pre-tokenizer cuts them (fixed value).
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHED_WORDS = 600_000  # of a Python worker; the cache starts anew beyond
BATCH_BYTES = 4 << 20


class Vocabulary(NamedTuple):
    tokens: list[bytes]            # id -> bytes
    byte_ids: np.ndarray           # byte -> id
    pair_keys: np.ndarray          # left << 32 | right, ascending
    pair_ranks: np.ndarray         # rank of each key
    left: np.ndarray               # rank -> ids
    right: np.ndarray
    merged: np.ndarray
    added: dict[str, int]


def byte_letters() -> dict[str, int]:
    """The printable stand-in of every byte in byte-level vocabulary files:
    printable Latin-1 letters stand for themselves, the others follow from 256 up."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    table, spare = {chr(b): b for b in plain}, 256
    for b in range(256):
        if b not in plain:
            table[chr(spare)] = b
            spare += 1
    return table


def load_vocabulary(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    ids, letters = spec["model"]["vocab"], byte_letters()
    added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    size = max([*ids.values(), *added.values()]) + 1
    tokens = [b""] * size
    for text, i in ids.items():
        tokens[i] = bytes(letters[c] for c in text) if all(c in letters for c in text) else text.encode()
    for text, i in added.items():
        tokens[i] = text.encode()
    byte_ids = np.zeros(256, np.int64)
    for c, b in letters.items():
        byte_ids[b] = ids[c]
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
    left = np.array([ids[a] for a, _ in merges], np.int64)
    right = np.array([ids[b] for _, b in merges], np.int64)
    merged = np.array([ids[a + b] for a, b in merges], np.int64)
    keys = left << 32 | right
    order = np.argsort(keys, kind="stable")
    return Vocabulary(tokens, byte_ids, keys[order], order, left, right, merged, added)


def ranks_of(vocabulary: Vocabulary, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Merge rank of each pair, -1 where there is none."""
    keys = left << 32 | right
    if len(vocabulary.pair_keys) == 0:
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(vocabulary.pair_keys, keys), len(vocabulary.pair_keys) - 1)
    return np.where(vocabulary.pair_keys[at] == keys, vocabulary.pair_ranks[at], -1)


def merge_words(vocabulary: Vocabulary, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of the words, one after the other, and how many each has; all
    words are merged together rank by rank."""
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    lens = np.array([len(w) for w in words])
    symbol = vocabulary.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
    n = len(symbol)
    stops = np.cumsum(lens)
    following = np.arange(1, n + 1)
    following[stops[lens > 0] - 1] = -1
    before = np.arange(-1, n - 1)
    before[(stops - lens)[lens > 0]] = -1
    occurrences: dict[int, list[np.ndarray]] = {}
    active: list[int] = []

    def index(positions: np.ndarray) -> None:
        """Enter the pairs that begin at ``positions``."""
        positions = positions[following[positions] >= 0]
        if not len(positions):
            return
        rank = ranks_of(vocabulary, symbol[positions], symbol[following[positions]])
        positions, rank = positions[rank >= 0], rank[rank >= 0]
        if not len(positions):
            return
        order = np.argsort(rank, kind="stable")
        positions, rank = positions[order], rank[order]
        cuts = np.flatnonzero(np.diff(rank)) + 1
        for part in zip(rank[np.concatenate(([0], cuts))].tolist(), np.split(positions, cuts), strict=True):
            if part[0] not in occurrences:
                occurrences[part[0]] = []
                heapq.heappush(active, part[0])
            occurrences[part[0]].append(part[1])

    index(np.arange(n))
    while active:
        rank = heapq.heappop(active)
        found = occurrences.pop(rank)
        at = found[0] if len(found) == 1 else np.unique(np.concatenate(found))
        a, b = vocabulary.left[rank], vocabulary.right[rank]
        at = at[(symbol[at] == a) & (following[at] >= 0)]
        at = at[symbol[following[at]] == b]
        if a == b and len(at) > 1:  # overlapping pairs merge from the left
            chosen, taken = [], -1
            for p, q in zip(at.tolist(), following[at].tolist(), strict=True):
                if p != taken:
                    chosen.append(p)
                    taken = q
            at = np.array(chosen, np.int64)
        if not len(at):
            continue
        gone = following[at]
        after = following[gone]
        symbol[at] = vocabulary.merged[rank]
        symbol[gone] = -1
        following[at] = after
        before[after[after >= 0]] = at[after >= 0]
        previous = before[at]
        index(np.unique(np.concatenate((at, previous[previous >= 0]))))
    alive = symbol >= 0
    kept = np.concatenate(([0], np.cumsum(alive)))
    return symbol[alive], kept[stops] - kept[stops - lens]


class Encoder:
    """Encodes and decodes batches of texts with one vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.words = regex.compile(WORD_PATTERN)
        contents = sorted(vocabulary.added, key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, contents))) if contents else None
        self.forget()
        sizes = np.array([len(t) for t in vocabulary.tokens])
        self.token_bytes = np.frombuffer(b"".join(vocabulary.tokens), np.uint8)
        self.token_starts = np.concatenate(([0], np.cumsum(sizes)))

    def split(self, text: str) -> list[str]:
        """Words and added tokens of a text, in order."""
        if self.added is None or not self.added.search(text):
            return self.words.findall(text)
        out, at = [], 0
        for m in self.added.finditer(text):
            out += self.words.findall(text[at:m.start()])
            out.append(m.group())
            at = m.end()
        return out + self.words.findall(text[at:])

    def forget(self) -> None:
        self.place: dict[str, int] = {}       # word -> place in the next three
        self.written: list[str] = []          # its ids as text
        self.starts = np.zeros(1, np.int64)   # its ids are flat[starts[k]:starts[k + 1]]
        self.flat = np.zeros(0, np.int64)

    def learn(self, words: set[str]) -> None:
        """Enter words that are not known yet."""
        new = sorted(words - self.place.keys())
        if len(self.place) + len(new) > CACHED_WORDS and self.place:
            self.forget()
            new = sorted(words)
        if not new:
            return
        plain = [w for w in new if w not in self.vocabulary.added]
        extra = [w for w in new if w in self.vocabulary.added]
        ids, sizes = merge_words(self.vocabulary, [w.encode() for w in plain])
        ids = np.concatenate([ids, np.array([self.vocabulary.added[w] for w in extra], np.int64)])
        sizes = np.concatenate([sizes, np.ones(len(extra), np.int64)])
        stops = np.cumsum(sizes).tolist()
        texts = list(map(str, ids.tolist()))
        self.written += [",".join(texts[a:b]) for a, b in zip([0, *stops], stops)]
        for w in plain + extra:
            self.place[w] = len(self.place)
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        self.flat = np.concatenate([self.flat, ids])

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[str]]:
        """Token ids of each text, and the same as decimal text joined by commas."""
        pieces = [self.split(t) for t in texts]
        self.learn(set().union(*pieces))
        places = [list(map(self.place.__getitem__, p)) for p in pieces]
        written = [",".join(map(self.written.__getitem__, p)) for p in places]
        at = np.concatenate([np.array(p, np.int64) for p in places]) if places else np.zeros(0, np.int64)
        sizes = self.starts[at + 1] - self.starts[at]
        ends = np.concatenate(([0], np.cumsum(sizes)))
        ids = self.flat[np.arange(ends[-1]) + np.repeat(self.starts[at] - ends[:-1], sizes)]
        cuts = ends[np.cumsum([len(p) for p in places])[:-1]] if len(places) > 1 else []
        return (np.split(ids, cuts) if places else []), written

    def decode(self, ids: np.ndarray) -> bytes:
        """Text of token ids, in UTF-8."""
        ids = ids[(ids >= 0) & (ids < len(self.vocabulary.tokens))]
        if not len(ids):
            return b""
        starts = self.token_starts[ids]
        sizes = self.token_starts[ids + 1] - starts
        ends = np.cumsum(sizes)
        data = self.token_bytes[np.arange(ends[-1]) + np.repeat(starts - (ends - sizes), sizes)].tobytes()
        return data.decode("utf-8", "replace").encode()


def _encoder(shared) -> Encoder:
    """One encoder a Python worker and vocabulary: its word cache is reused."""
    global _LAST
    if _LAST is None or _LAST[0] is not shared.value:
        _LAST = (shared.value, Encoder(shared.value))
    return _LAST[1]


_LAST: tuple[Vocabulary, Encoder] | None = None


def _shared(df: DataFrame, path: str):
    """The vocabulary as a broadcast (its size is that of the tokenizer file)."""
    ship_package(df.sparkSession)
    return df.sparkSession.sparkContext.broadcast(load_vocabulary(path))


def _texts(column: pa.Array) -> Iterator[list[str]]:
    """A column as lists of whole texts, about ``BATCH_BYTES`` at a time."""
    for first, last, _, _ in text_chunks(column, BATCH_BYTES):
        yield [t or "" for t in column.slice(first, last - first).to_pylist()]


def encode(docs: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """Add the token ids of ``text`` as ``array<int>``."""
    shared = _shared(docs, path)

    @F.arrow_udf("array<int>")
    def apply(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            ids = [x for texts in _texts(column) for x in _encoder(shared).encode(texts)[0]]
            yield pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32()))

    return docs.withColumn(out, apply(text))


def decode(rows: DataFrame, path: str, ids: str = "ids", out: str = "text") -> DataFrame:
    """Add the text of an ``array<int>`` of token ids (null: empty)."""
    shared = _shared(rows, path)

    @F.arrow_udf("string")
    def apply(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            yield pa.array([_encoder(shared).decode(np.array([i for i in x or [] if i is not None], np.int64)).decode()
                            for x in column.to_pylist()], pa.string())

    return rows.withColumn(out, apply(ids))


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` of every whole text:
    encoded, then decoded from the ids."""
    shared = _shared(docs, path)

    @F.arrow_udf("n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    def apply(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            counts, encoded, decoded = [], [], []
            for texts in _texts(column):
                ids, written = _encoder(shared).encode(texts)
                counts += [len(x) for x in ids]
                encoded += [hashlib.sha256(x.encode()).hexdigest() for x in written]
                decoded += [hashlib.sha256(_encoder(shared).decode(x)).hexdigest() for x in ids]
            yield pa.StructArray.from_arrays(
                [pa.array(counts, pa.int64()), pa.array(encoded, pa.string()), pa.array(decoded, pa.string())],
                ["n_tokens", "ids_sha256", "decoded_sha256"])

    return (docs.select("doc_id", apply("text").alias("found"))
            .select("doc_id", "found.n_tokens", "found.ids_sha256", "found.decoded_sha256"))
