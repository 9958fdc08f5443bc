from __future__ import annotations

import numpy as np
import pytest

from trafficlens.llm import textops as tx

MASK = (1 << 64) - 1


def polynomial(word):
    total, power = 0, 1
    for b in word:
        total = (total + int(tx._BYTE_CODE[b]) * power) & MASK
        power = power * int(tx._BASE) & MASK
    return total


@pytest.mark.parametrize("size, spaces", [(0, 0.2), (1, 0), (3000, 0.2), (3000, 0.9), (2 * tx.HASH_BYTES, 0.001)])
def test_span_hashes_are_those_of_the_words_alone(size, spaces):
    rng = np.random.default_rng(3)
    data = rng.integers(33, 256, size).astype(np.uint8)
    data[rng.random(size) < spaces] = 32
    starts, ends, _ = tx.word_spans(data, np.array([0, size]))
    plain = np.array([polynomial(data[a:b].tolist()) for a, b in zip(starts, ends, strict=True)], np.uint64)
    assert np.array_equal(tx.span_hashes(data, starts, ends), tx.mix64(plain + (ends - starts).astype(np.uint64) * tx._STEP))


def test_a_text_of_one_long_word_and_its_neighbours():
    long = b"x" * (tx.HASH_BYTES + 5)
    data = np.frombuffer(b"ab " + long + b" ab " + long + b"y", np.uint8)
    starts, ends, _ = tx.word_spans(data, np.array([0, len(data)]))
    h = tx.span_hashes(data, starts, ends)
    assert len(h) == 4 and h[0] == h[2] and len(set(h.tolist())) == 3
    assert h[1] == tx.mix64(np.array([polynomial(long) + len(long) * int(tx._STEP) & MASK], np.uint64))[0]


def test_words_are_hashed_in_bounded_runs():
    """A text of many words needs working arrays of a run, not of the text."""
    import tracemalloc
    data = np.frombuffer(b"word " * 1_000_000, np.uint8)
    starts, ends, _ = tx.word_spans(data, np.array([0, len(data)]))
    tracemalloc.start()
    tx.span_hashes(data, starts, ends)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 10 * len(data)
