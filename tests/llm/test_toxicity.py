"""Held-out accuracy on the given labels and edge cases."""

import zlib

import pytest
from pyspark.sql import functions as F

from propensity.llm import queries, toxicity


@pytest.fixture(scope="module")
def scored(spark):
    sf = "/root/testdata/sf0.1"
    rows = queries.toxicity_scores(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    return [r for r in rows if r.held_out]


def test_held_out_accuracy(scored):
    toxic = [r for r in scored if r.toxic == 1]
    clean = [r for r in scored if r.toxic == 0]
    assert len(toxic) > 80
    assert sum(r.predicted for r in toxic) / len(toxic) > 0.65  # with some 330 toxic documents to learn from
    assert sum(r.predicted for r in clean) / len(clean) < 0.05


def test_edges(spark):
    docs = spark.createDataFrame(
        [(i, ("you idiot scum " if i % 2 else "calm sunny words ") * 5 + str(i), "c") for i in range(60)]
        + [(100, None, "c"), (101, "", "c"), (102, "idiot " * 30000, "c"), (None, "scum", "c"), (1, "again", "c")],
        "doc_id bigint, text string, score string")
    labels = spark.createDataFrame([(i, i % 2, 1) for i in range(60)] + [(1, 1, 1), (None, 1, 1), (5, None, 1)],
                                   "doc_id bigint, toxic int, quality int")
    model = toxicity.fit(docs, labels)
    rows = toxicity.score_documents(docs, model).collect()
    assert len(rows) == 65 and all(0 <= r.score <= 1 for r in rows)
    none = toxicity.fit(docs, labels.filter("toxic = 0"))
    assert {r.score for r in toxicity.score_documents(docs, none).collect()} == {0.0}
    assert toxicity.score_documents(docs.limit(0), toxicity.fit(docs.limit(0), labels.limit(0))).count() == 0


def test_windows_cover_the_text():
    for text in ("", "a" * 1000, "word " * 500, "é " * 100):
        assert b"".join(toxicity.windows(text)) == text.encode()
