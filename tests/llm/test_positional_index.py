"""Benchmark passages against a direct comparison of every window with every place."""

import random
import re

import numpy as np
import pytest

from propensity.llm import positional_index as pi

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lowered)


def brute(docs, items, width):
    out = []
    for d, t in docs:
        w = words(t)
        hit, names = set(), set()
        for i, x in items:
            iw = words(x)
            if not iw:
                continue
            k = min(width, len(iw))
            windows = {tuple(iw[s:s + k]) for s in range(len(iw) - k + 1)}
            for s in range(len(w) - k + 1):
                if tuple(w[s:s + k]) in windows:
                    hit |= set(range(s, s + k))
                    names |= {str(i)} - {"None"}
        out.append((d, len(w), len(hit), sorted(names)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block_words", [1_000_000, 20])
def test_equals_direct_comparison(spark, block_words):
    rng = random.Random(3)
    vocabulary = ["the", "of", "und", "É", "naïve", "x1", "A", "b", "zebra", "quartz"]
    draw = lambda n: " ".join(rng.choices(vocabulary, weights=[9, 9, 5, 3, 2, 2, 2, 1, 1, 1], k=n))
    items = [(i, draw(rng.randint(1, 12))) for i in range(8)] + [(8, None), (9, "..."), (10, "THE, the"), (None, "the")]
    items.append((11, items[0][1]))
    docs = [(i, draw(rng.randint(0, 40))) for i in range(40)]
    docs += [(100, None), (101, ""), (102, items[1][1] + "! " + draw(5)), (103, items[0][1].upper()), (104, "the " * 3000)]
    left = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id bigint, text string, hits string").repartition(4)
    right = spark.createDataFrame(items, "item_id bigint, text string")
    got = pi.find_passages(left, right, width=5, block_words=block_words).collect()
    rows = sorted([(r.doc_id, r.n_words, sum(h.end - h.start for h in r.hits), list(r["items"])) for r in got], key=str)
    assert rows == brute(docs, items, 5)
    assert any(n for _, _, n, _ in rows)


def test_repeated_rows_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (1, "zz"), (None, "a b c d e f")], "doc_id bigint, text string")
    items = spark.createDataFrame([(7, "a b c d e")], "item_id bigint, text string")
    rows = sorted((str(r.doc_id), r.n_words, len(r.hits)) for r in pi.find_passages(docs, items, width=5).collect())
    assert rows == [("1", 1, 0), ("1", 6, 1), ("1", 6, 1), ("None", 6, 1)]
    assert pi.find_passages(docs, items.limit(0)).count() == 4
    assert pi.find_passages(docs.limit(0), items).count() == 0


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "quick brown fox jumps"), (2, "quick x brown y fox"), (3, "fox brown quick"),
                                  (4, "quick a b c d e f g h i j k l brown fox")], "doc_id bigint, text string").coalesce(1)
    items = spark.createDataFrame([(9, "quick brown fox"), (8, None)], "item_id bigint, text string")
    near = lambda slop, **more: {(r.doc_id, r["item"]) for r in pi.proximity_matches(docs, items, slop=slop, **more).collect()}
    assert near(3) == near(3, block_words=1) == {(1, "9"), (2, "9")}
    assert near(5) == {(1, "9"), (2, "9"), (3, "9")}
    assert near(0) == {(1, "9")}
    assert pi.proximity_matches(docs, items.limit(0)).count() == 0


def test_windows_that_cannot_occur_and_equal_windows():
    block = pi.windows_of([(1, "a b c"), (2, "A, b; c"), (None, "a b c"), (3, "a zz c")], 10)
    assert len(block) == 2 and block.owners == [["1", "2"], ["3"]]
    often = np.where(block.vocabulary == pi.Words(pi.pa.array(["zz"])).hashes[0], 0, 5)
    windows, terms, offsets = block.anchors(often, 5)
    assert windows.tolist() == [0] and sorted(offsets[0].tolist()) == [-1, -1, 0, 1, 2] and (terms[0] < 0).sum() == 2


def test_clashing_columns_and_slices(spark, monkeypatch):
    names = ["docs", "found", "__found", "n_words", "terms"]
    docs = spark.createDataFrame([(None, "x a b c", 1, None, "p", 2.0, "t"), (5, "a b", 2, "f", "q", 3.0, "u"), (5, "c a b c", 3, "g", "r", None, "v")],
                                 "doc_id bigint, text string, docs int, found string, __found string, n_words double, terms string")
    items = spark.createDataFrame([(1, "a b c")], "item_id bigint, text string")
    left = pi.drop_contaminated(docs, items)
    assert left.columns == ["doc_id", "text", *names]
    assert [tuple(r) for r in left.collect()] == [(5, "a b", 2, "f", "q", 3.0, "u")]
    index = pi.Postings(np.array([6]), np.array([0, 1]), np.array([3, 3]), np.array([0, 2, 4, 1, 3, 5]), 2, 10)
    monkeypatch.setattr(pi, "CANDIDATES", 1)
    got = [(w, s) for win, start in index.phrases(np.array([[0, 1], [1, 0]]), np.array([[0, 1], [0, 1]])) for w, s in zip(win.tolist(), start.tolist())]
    assert sorted(got) == [(0, 0), (0, 2), (0, 4), (1, 1), (1, 3)]
