"""The pipeline against its decisions made one by one on the small tables."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

import corpus_pipeline
from propensity.llm import queries, secret_index
from .test_positional_index import brute as passages
from .test_secret_index import brute as secrets


@pytest.fixture(scope="module")
def sf_dir(spark, small, tmp_path_factory):
    """The small tables with edge rows among the documents."""
    d = tmp_path_factory.mktemp("sf")
    docs = spark.read.parquet(f"{small}/documents.parquet")
    item = spark.read.parquet(f"{small}/benchmark.parquet").first().text
    extra = [(10**6, None, "en", "s", None), (10**6 + 1, "", "en", "s", 0), (None, "no id here", None, None, 10),
             (10**6 + 2, "leak " + item, "en", "s", 1), (10**6 + 3, "key = x token: abcdefghijklmnop", "en", "s", 1),
             (10**6 + 4, "Key = x token: abcdefghijklmnop!", "en", "s", 1)]
    docs.unionByName(spark.createDataFrame(extra, docs.schema)).repartition(4).write.parquet(f"{d}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{small}/{t}.parquet").write.parquet(f"{d}/{t}.parquet")
    return str(d)


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    toxic = {r.doc_id for r in queries.toxicity_scores(spark, sf_dir).filter("predicted = 1").collect()}
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == columns
        seen[name] = (docs.collect(), out.collect())
        docs = spark.createDataFrame(seen[name][1], docs.schema)
    before, after = seen["toxicity"]
    assert {r.doc_id for r in after} == {r.doc_id for r in before if r.doc_id not in toxic}
    before, after = seen["near_duplicates"]
    texts = {}
    for r in sorted((r for r in before if r.doc_id is not None), key=lambda r: r.doc_id):
        texts.setdefault(r.text or "", r.doc_id)
    left = {r.doc_id for r in after}
    assert None in left and left - {None} <= set(texts.values()) and len(left) > 0.8 * len(texts)
    assert 10**6 + 3 in left and 10**6 + 4 not in left
    before, after = seen["benchmark_passages"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    hit = {d for d, _, n, _ in passages([(r.doc_id, r.text) for r in before], items, 10) if n}
    assert {r.doc_id for r in after} == {r.doc_id for r in before} - hit and 10**6 + 2 in hit
    before, after = seen["secrets"]
    clean = {r.doc_id: r for r in after}
    assert len(after) == len(before)
    for r in before:
        if not secrets(r.text, secret_index.RULES):
            assert clean[r.doc_id] == r
        else:
            assert "[secret]" in clean[r.doc_id].text and clean[r.doc_id].n_chars == len(clean[r.doc_id].text)
            assert not secrets(clean[r.doc_id].text, secret_index.RULES)


def test_run(spark, sf_dir):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert 100 < len(rows) < len(texts)
    for r in rows:
        if not secrets(texts[r.doc_id], secret_index.RULES):
            ids = [1] + library.encode(texts[r.doc_id] or "") + [2]
            assert r.ids == ids and r.n_tokens == len(ids)
            assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
