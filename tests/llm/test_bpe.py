from __future__ import annotations

import hashlib

import pandas as pd
import pytest

from trafficlens.llm import bpe

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")
PATH = public.path("byte_bpe_50k.json")

TEXTS = ["", "a" * 301 + "bb aaa", "x<|endoftext|>y <|endoftext|><|endoftext|>  \n\n z", " \t\n  é漢字 😀😀!!  ",
         "'s 'll I'm it's", "\x00\xad ab" * 5, "  ", "Hello world " * 50, "ababababab aaaa", "1234567 89.5%", "İstanbul ß"]


def expected(texts):
    t = tokenizers.Tokenizer.from_file(PATH)
    out = []
    for text in texts:
        ids = t.encode(text or "", add_special_tokens=False).ids
        out.append((len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                    hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    return out


def test_round_trip_equals_the_library(make_docs):
    texts = TEXTS + pd.read_parquet("/root/testdata/sf0.001/documents.parquet").text.tolist() + [None, None]
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"])
           for r in bpe.round_trip(make_docs(list(enumerate(texts))), PATH).collect()}
    assert [got[i] for i in range(len(texts))] == expected(texts)


def test_small_caches_give_the_same_ids(monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_WORDS", 7)
    encoder = bpe.Encoder(bpe.load_vocabulary(PATH))
    t = tokenizers.Tokenizer.from_file(PATH)
    for text in TEXTS:
        ids, written = encoder.encode([text])
        assert ids[0].tolist() == t.encode(text, add_special_tokens=False).ids
        assert written[0] == ",".join(map(str, ids[0].tolist()))


def test_encode_and_decode_columns(make_docs):
    docs = make_docs(list(enumerate(TEXTS)) + [(99, None)])
    back = bpe.decode(bpe.encode(docs, PATH), PATH, out="back").collect()
    t = tokenizers.Tokenizer.from_file(PATH)
    assert len(back) == len(TEXTS) + 1
    for r in back:
        assert r["ids"] == t.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["back"] == t.decode(r["ids"], skip_special_tokens=False)
    assert bpe.round_trip(docs.limit(0), PATH).collect() == []


def test_ids_without_an_entry_decode_to_nothing():
    import numpy as np
    encoder = bpe.Encoder(bpe.load_vocabulary(PATH))
    assert encoder.decode(np.array([-1, 10**6])) == b""
    assert encoder.decode(np.array([encoder.vocabulary.byte_ids[0xFF]])) == "�".encode()
