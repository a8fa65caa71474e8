"""Backtracking against the sentencepiece library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from propensity.llm import piece_encoding as pe

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_random_texts(library):
    enc = pe.PieceEncoder(MODEL)
    rng = random.Random(5)
    parts = ["the", "in", " ", "  ", "▁", "er", "on", "ing", "é", "1", "(", ")", "\n", "\t", "and", "==", "//", "中", "\x00",
             "ﬁ", "İ", "<s>", "<0x41>", "é", "😀", "aaaa", "ab"]
    for _ in range(4000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 20)))
        assert enc.encode(t).tolist() == [1] + library.encode(t) + [2], t


def test_backtracks_where_the_longest_piece_fails():
    enc = pe.PieceEncoder(MODEL)
    words = ["ingingtheheinandtionon" * 3, "aaaaaaaaaaaaaaaaaaaa", "tttthhhheeee"]
    for w in words:
        assert enc.backtrack(w) == enc.merge(w)


def test_small_cache_gives_the_same(library, monkeypatch):
    monkeypatch.setattr(pe, "CACHE", 3)
    enc = pe.PieceEncoder(MODEL)
    t = "one two three four five one two six seven one " * 3 + "x"
    assert enc.encode(t).tolist() == [1] + library.encode(t) + [2]


def test_documents(spark, small, library):
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(60)
    edge = spark.createDataFrame([(-1, None), (-2, ""), (-3, "x " * 50000), (-3, "y"), (None, "z")], "doc_id bigint, text string")
    docs = docs.select("doc_id", "text").unionByName(edge)
    want = {}
    for r in docs.collect():
        ids = [1] + library.encode(r.text or "") + [2]
        want.setdefault(r.doc_id, set()).add((
            len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    rows = pe.encode_documents(docs.withColumn("ids", docs.text), MODEL).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) in want[r.doc_id]
        assert len(r.ids) == r.n_tokens and r.decoded == library.decode(r.ids)
    assert pe.encode_documents(docs.limit(0), MODEL, ids=False).count() == 0
