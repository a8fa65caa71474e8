"""Removed passages against a direct comparison of all windows."""

import hashlib
import random

import pytest

from propensity.llm import suffix_sort as ss


def brute(rows, depth):
    first = {}
    raw = [(d, (t or "").encode()) for d, t in rows]
    for d, b in raw:
        if d is None:
            continue
        for s in range(len(b) - depth + 1):
            w = b[s:s + depth]
            first[w] = min(first.get(w, d), d)
    out = []
    for d, b in raw:
        gone = bytearray(len(b))
        if d is not None:
            for s in range(len(b) - depth + 1):
                if first[b[s:s + depth]] < d:
                    gone[s:s + depth] = b"\1" * depth
        kept = bytes(x for x, g in zip(b, gone) if not g)
        n = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((d, len(b), sum(gone), n, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def check(spark, rows, depth, buckets=None):
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id bigint, text string, id int").repartition(4)
    got = ss.remove_repeats(df, depth=depth, buckets=buckets).collect()
    assert sorted([(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got], key=str) == brute(rows, depth)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got)
    return got


@pytest.mark.parametrize("alphabet,depth,buckets", [("ab", 8, 5), ("abcé ", 12, None), ("abcdefgh", 50, 16)])
def test_equals_all_windows(spark, alphabet, depth, buckets):
    rng = random.Random(depth)
    draw = lambda n: "".join(rng.choice(alphabet) for _ in range(n))
    passages = [draw(depth + rng.randint(-2, 60)) for _ in range(6)]
    rows = []
    for d in range(60):
        rows.append((d, "".join(rng.choice([draw(rng.randint(0, 40)), rng.choice(passages)]) for _ in range(rng.randint(0, 6)))))
    rng.shuffle(rows)
    rows += [(500 + d, rows[3][1]) for d in range(5)] + [(600, None), (601, ""), (None, passages[0] * 2), (None, None),
                                                        (602, passages[1]), (602, passages[2]), (602, passages[2]), (603, "a" * 20000), (604, "a" * 300)]
    got = check(spark, rows, depth, buckets)
    assert sum(r.n_removed for r in got) > 500


def test_empty(spark):
    assert ss.remove_repeats(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_places_beyond_the_bits_of_a_key(monkeypatch):
    import numpy as np

    from propensity.llm import suffix_sort
    from propensity.llm.arrow_text import prefix_sums, span_hashes

    mask = 0xFFFFFFFFFFFFFFFF << 6 & 0xFFFFFFFFFFFFFFFF  # six bits stand for the 26 of a text over 64 MiB
    monkeypatch.setattr(suffix_sort, "_HASH_BITS", np.uint64(mask))
    data = np.random.default_rng(3).integers(97, 122, 1000).astype(np.uint8)
    at = np.arange(len(data) - 23)
    h = span_hashes(prefix_sums(data), at, at + 24).tolist()
    want = [min(range(s, s + 27), key=lambda i: (h[i] & mask, i)) for s in range(len(data) - 49)]
    _, place, first, last, _ = suffix_sort.sampled(data, np.array([0, len(data)]), 50, 24)
    assert [p for p, a, b in zip(place, first, last) for _ in range(a, b + 1)] == want


def test_windows_longer_than_a_byte_counts(spark):
    rng = random.Random(9)
    draw = lambda n: "".join(rng.choice("abcdef") for _ in range(n))
    shared = draw(700)
    rows = [(d, draw(rng.randint(0, 300)) + shared[rng.randint(0, 200):rng.randint(350, 700)] + draw(50)) for d in range(30)]
    got = check(spark, rows, 300, 4)
    assert sum(r.n_removed for r in got) > 500


def test_windows_with_one_key_are_told_apart_by_their_bytes():
    import numpy as np

    from propensity.llm import suffix_sort

    rng = np.random.default_rng(4)
    for depth in (1, 3, 8, 13, 50):
        raw = rng.integers(97, 99, 400).astype(np.uint8)
        at = rng.integers(0, len(raw) - depth + 1, 300)
        for key in (np.zeros(300, np.uint64), (at % 3).astype(np.uint64)):
            got = suffix_sort.equal_groups(raw, at, key, depth)
            texts = [(int(k), raw[a:a + depth].tobytes()) for k, a in zip(key, at)]
            assert len(set(zip(got.tolist(), texts))) == len(set(got.tolist())) == len(set(texts))


def test_slices_hold_every_entry_once_and_divide_no_digit(monkeypatch):
    import numpy as np

    from propensity.llm import suffix_sort

    monkeypatch.setattr(suffix_sort, "SLICE", 50)
    rng = np.random.default_rng(5)
    items = []
    for i in range(4):
        n = 40 + i
        h = np.sort(rng.integers(0, 30, n).astype(np.uint64))
        length = rng.integers(10, 15, n).astype(np.uint8)
        ids = np.arange(n) + 100 * i
        items.append([ids, ids, ids, ids, length, h, np.repeat(ids, length).astype(np.uint16)])
    parts = list(suffix_sort._slices(items, 10))
    assert len(parts) > 5 and sorted(np.concatenate([p[0] for p in parts])) == sorted(np.concatenate([x[0] for x in items]))
    assert sum(len(set(p[5].tolist())) for p in parts) == len(set(np.concatenate([x[5] for x in items]).tolist()))
    assert all((np.repeat(p[0], p[4]) == p[6]).all() for p in parts)
    assert list(suffix_sort._slices([], 10)) == []
