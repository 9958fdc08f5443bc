"""Array helpers over Arrow text columns: whole-text word spans and hashes.

Everything works on the UTF-8 bytes of an Arrow array, many documents at a
time. Words are maximal runs of bytes other than 0x20 and 0x09-0x0D; these
bytes never occur inside a multi-byte character, so byte spans are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes of text handled in one go: bounds the working arrays (about 40 bytes per
# text byte) without cutting any document.
CHUNK_BYTES = 1 << 20
HASH_BYTES = 1 << 15  # bytes of words hashed in one go; a longer word goes alone

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_rng = np.random.default_rng(20240229)
_BYTE_CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_LOWER_CODE = _BYTE_CODE[_LOWER]
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD1342543DE82EF95)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finalizer (splitmix64 constants)."""
    y = x >> np.uint64(30)
    y ^= x
    y *= np.uint64(0xBF58476D1CE4E5B9)
    y ^= y >> np.uint64(27)
    y *= np.uint64(0x94D049BB133111EB)
    y ^= y >> np.uint64(31)
    return y


def text_chunks(column: pa.Array, max_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string column into runs of whole documents of about ``max_bytes``.

    Yields ``(first_row, last_row, data, offsets)``: ``data`` the UTF-8 bytes of
    the rows, ``offsets`` (rows + 1) into it. A null is an empty text; a text
    longer than ``max_bytes`` is a chunk of its own.
    """
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    n = len(column)
    if n == 0:
        return
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + max_bytes, side="right")) - 1
        last = min(n, max(first + 1, last))
        yield first, last, raw[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, other bytes unchanged."""
    return _LOWER[data]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte spans of the words: ``starts``, ``ends`` and ``word_offsets``
    (documents + 1: the words of document d are word_offsets[d]:word_offsets[d + 1])."""
    n = len(data)
    if n == 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(offsets), np.int64)
    inside = (data != 0x20) & (data - np.uint8(9) > 4)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cuts = offsets[1:-1]
    cuts = cuts[cuts < n]
    begins[cuts] = inside[cuts]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    before = cuts[cuts > 0] - 1
    stops[before] = inside[before]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWER = _powers(int(_BASE), HASH_BYTES)
_INVERSE = _powers(pow(int(_BASE), -1, 1 << 64), HASH_BYTES)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hash of each byte span (spans ascend, do not overlap and are not empty);
    ``lower``: as if A-Z were lower-cased.

    A span's polynomial is the difference of two running sums over a run of
    spans, times the inverse power of its place in the run."""
    out = np.empty(len(starts), np.uint64)
    codes = _LOWER_CODE if lower else _BYTE_CODE
    first = 0
    while first < len(starts):
        low = int(starts[first])
        last = max(first + 1, int(np.searchsorted(ends, low + HASH_BYTES, side="right")))
        a, b = starts[first:last] - low, ends[first:last] - low
        n = int(b[-1])
        sums = np.zeros(n + 1, np.uint64)
        terms = codes.take(data[low:low + n])
        terms *= _POWER[:n] if n <= HASH_BYTES else _powers(int(_BASE), n)
        np.cumsum(terms, out=sums[1:])
        out[first:last] = (sums[b] - sums[a]) * _INVERSE[a]
        first = last
    return mix64(out + (ends - starts).astype(np.uint64) * _STEP)


def shingle_hashes(words: np.ndarray, word_offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``size``-word shingles of every document, in text order,
    and their offsets by document. A document of fewer words has its whole
    sequence as its one shingle; one without words has none."""
    counts = np.diff(word_offsets)
    n = len(words)
    many = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    offsets = np.concatenate(([0], np.cumsum(many)))
    out = np.empty(int(offsets[-1]), np.uint64)
    if n >= size:
        rolled = words[:n - size + 1].copy()
        for k in range(1, size):
            rolled *= _STEP
            rolled += words[k:n - size + 1 + k]
            rolled = mix64(rolled)
        for d in np.flatnonzero(counts >= size).tolist():
            out[offsets[d]:offsets[d + 1]] = rolled[word_offsets[d]:word_offsets[d + 1] - size + 1]
    for d in np.flatnonzero((counts > 0) & (counts < size)):
        h = np.array([counts[d]], np.uint64)
        for w in words[word_offsets[d]:word_offsets[d + 1]]:
            h = mix64(h * _STEP + w)
        out[offsets[d]] = mix64(h ^ _BASE)[0]
    return out, offsets


def document_shingles(data: np.ndarray, offsets: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """A-Z lower-cased word shingle hashes of each document, in text order."""
    starts, ends, word_offsets = word_spans(data, offsets)
    return shingle_hashes(span_hashes(data, starts, ends, lower=True), word_offsets, size)
