"""Token files: round trips, random access, and the library's own ids."""

import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from propensity.llm import token_codes as tc

MODEL = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("n", [0, 1, 7, 511, 512, 513, 5000])
def test_round_trip_and_random_access(n):
    rng = np.random.default_rng(n)
    ids = rng.choice([0, 1, 255, 256, 300, 65535, 65536, 2**24 - 1, 2**31], n).astype(np.uint32)
    packed = tc.PackedIds(tc.pack_ids(ids))
    assert len(packed) == n
    assert np.array_equal(packed.slice(0, n), ids)
    assert [packed[i] for i in range(min(n, 700))] == ids[:700].tolist()
    for a, b in [(0, 0), (n // 3, n // 2), (n, n), (n // 2, n)]:
        assert np.array_equal(packed.slice(a, b), ids[a:b])


def test_segment():
    seg = tc.Segment(tc.pack_segment(np.array([5, 9]), np.array([2, 3]), np.array([1, 70000, 3, 4, 500])))
    assert seg.keys.tolist() == [5, 9] and seg.document(1).tolist() == [3, 4, 500] and seg.ids[1] == 70000


@pytest.mark.parametrize("files,segment", [(1, 1 << 20), (4, 300)])
def test_documents(spark, small, files, segment):
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(80).select("doc_id", "text")
    edge = spark.createDataFrame([(10**9, None), (-2, ""), (-3, "x é　<|endoftext|> I'ḿ it's 12" * 20), (None, "none"),
                                  (7 * 10**9, "aa bb"), (7 * 10**9, "aa bb")], "doc_id bigint, text string")
    docs = docs.unionByName(edge).repartition(5)
    library = Tokenizer.from_file(MODEL)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rows.sort(key=lambda r: -(1 << 62) if r[0] is None else r[0])
    at, want = 0, []
    for d, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    path = tc.write_tokens(docs.withColumn("file", docs.text), MODEL, 2, files=files, segment=segment)
    got = tc.read_documents(spark.read.parquet(path)).collect()
    assert sorted([(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got], key=lambda r: r[1]) == want
    empty = tc.write_tokens(docs.limit(0), MODEL, 2)
    schema = "file int, seg int, before bigint, n_docs int, n_tokens bigint, image binary"
    assert tc.read_documents(spark.read.schema(schema).parquet(empty)).count() == 0


def test_other_settings_are_encoded_whole():
    library = Tokenizer.from_file(MODEL)
    texts = ["Two  words\n and\ta third", None, "", "it's \u00a0 I\u0301 x"]
    enc = tc.WordEncoder(MODEL)
    assert enc.by_word
    assert not tc._words_stand_alone({"normalizer": None, "pre_tokenizer": {"type": "Whitespace"}})
    for by_word in (True, False):
        enc.by_word = by_word
        ids, at = enc.encode_all(pa.array(texts), 2)
        got = [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])]
        assert got == [library.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]
    ids, at = enc.encode_all(pa.array([], pa.string()), 2)
    assert len(ids) == 0 and at.tolist() == [0]
