"""Order MinHash near-duplicates: alignment against dynamic programming, classes against all pairs."""

import random

import numpy as np
import pytest

from propensity.llm import order_minhash as om
from propensity.llm.components import components


def full_distance(a, b):
    d = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, d[0] = d[0], i
        for j, y in enumerate(b, 1):
            prev, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, prev + (x != y))
    return d[-1]


def test_banded_distance():
    rng = random.Random(4)
    for _ in range(1500):
        a = [rng.randint(0, 4) for _ in range(rng.randint(1, 40))]
        b = list(a)
        for _ in range(rng.randint(0, 12)):
            k = rng.randint(0, max(0, len(b) - 1))
            b[k:k + rng.randint(0, 2)] = [rng.randint(0, 4)] * rng.randint(0, 2)
        b = b or [1]
        x, y = np.array(a, np.uint64), np.array(b, np.uint64)
        want = full_distance(a, b)
        assert om.banded_distance(x, y, 100) == want
        assert om.banded_distance(x, y, want) == want
        assert want == 0 or om.banded_distance(x, y, want - 1) is None


def test_similarity():
    a = np.arange(100, dtype=np.uint64)
    b = a.copy()
    b[[20, 60]] = 1000, 1001
    assert om.similarity(a, b) == pytest.approx(0.98) and om.similarity(a, a) == 1.0
    assert om.similarity(a, np.concatenate([a, a[:25]])) == pytest.approx(0.8)
    assert om.similarity(a, np.concatenate([a, a[:26]])) == 0.0
    assert om.similarity(a, a[::-1].copy()) == 0.0 and om.similarity(a[:3], a[1:4]) == 0.0


def test_sketch_keeps_order():
    a = np.arange(60, dtype=np.uint64)
    assert (om.sketch(a) == om.sketch(a.copy())).all()
    assert (om.sketch(a) == om.sketch(np.concatenate([a[30:], a[:30]]))).mean() < 1
    assert (om.sketch(a[:2]) == om.sketch(a[:2].copy())).all()


def test_components(spark):
    rng = random.Random(8)
    links = [(rng.randint(0, 80), rng.randint(0, 80)) for _ in range(45)] + [(i, i + 1) for i in range(200, 230)] + [(5, 5), (300, 300), (None, 3)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {v: find(v) for v in parent}


def classes(texts, words):
    parent = {i: i for i in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(texts)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            wa, wb = words[a], words[b]
            same = (wa == wb) if wa else (texts[a] or "") == (texts[b] or "") and not wb
            if same or wa and wb and om.similarity(np.array(wa, np.uint64), np.array(wb, np.uint64)) >= 0.8:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("small,refine", [(40, (2, 4)), (3, (1,))])
def test_classes_equal_all_pairs(spark, monkeypatch, small, refine):
    monkeypatch.setattr(om, "SMALL", small)
    monkeypatch.setattr(om, "REFINE", refine)
    rng = random.Random(6)
    texts, n = {}, 0
    for base in range(6):
        w = [f"w{rng.randint(0, 400)}" for _ in range(rng.choice([120, 200]))]
        for _ in range(14 if base == 0 else rng.randint(1, 5)):
            v = list(w)
            for _ in range(rng.randint(0, 3)):
                k = rng.randrange(len(v))
                v[k:k + 1] = rng.choice([[], ["new", f"x{rng.randint(0, 99)}"], [f"y{rng.randint(0, 99)}"]])
            texts[n] = " ".join(v)
            n += 1
    texts |= {900: None, 901: "", 902: "!!", 903: "!!", 904: "a b", 905: "A, b.", 906: "b a", 907: texts[0], 908: texts[0] + " end", 909: "go " * 3000}
    codes = {}
    words = {i: [codes.setdefault(x, len(codes)) for x in __import__("re").findall(r"[a-z0-9]+", (t or "").lower())] for i, t in texts.items()}
    rows = [(i, t, "c") for i, t in texts.items()] + [(900, None, "again"), (None, texts[1], "c")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, label string").repartition(4)
    got = om.find_groups(docs, shingles=0).collect()
    assert {r.doc_id: r.component_id for r in got} == classes(texts, words)
    assert len(got) == len(texts) and all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_empty(spark):
    assert om.find_groups(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def jaccard(a, b):
    """Of the five-word shingles, each with its occurrence number; short texts are one shingle."""
    sets = []
    for w in (a, b):
        seen, out = {}, set()
        for i in range(max(1, len(w) - 4)):
            k = tuple(w[i:i + 5])
            seen[k] = seen.get(k, 0) + 1
            out.add((k, seen[k]))
        sets.append(out)
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def test_shingle_similarity():
    rng = random.Random(9)
    for _ in range(300):
        a = [rng.randint(0, 3) for _ in range(rng.randint(1, 60))]
        b = list(a)
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(len(b))
            b[k:k + 1] = [rng.randint(0, 3)] * rng.randint(1, 2)
        x, y = np.array(a, np.uint64), np.array(b, np.uint64)
        want = jaccard(a, b)
        assert om.shingle_similarity(x, y, 0.0) == pytest.approx(want)
        assert om.shingle_similarity(x, y, 0.8) == (pytest.approx(want) if want >= 0.8 else 0.0)
    form = np.arange(300, dtype=np.uint64)
    other = form.copy()
    other[::20] += np.uint64(1000)  # a form letter with other names: 5 % of the words
    assert om.similarity(form, other) >= 0.95 and om.linked(form, other, 0.8, 0.8) == 0.0


@pytest.mark.parametrize("small,refine", [(40, (2, 4)), (3, (1,))])
def test_shingle_classes_equal_all_pairs(spark, monkeypatch, small, refine):
    monkeypatch.setattr(om, "SMALL", small)
    monkeypatch.setattr(om, "REFINE", refine)
    rng = random.Random(6)
    words = {}
    for base in range(6):
        w = [f"w{rng.randint(0, 400)}" for _ in range(rng.choice([30, 120, 200]))]
        for _ in range(14 if base == 0 else rng.randint(1, 5)):
            v = list(w)
            for _ in range(rng.randint(0, 5)):
                k = rng.randrange(len(v))
                v[k:k + 1] = rng.choice([[], ["new", f"x{rng.randint(0, 99)}"], [f"y{rng.randint(0, 99)}"]])
            words[len(words)] = v
    form = [f"f{i}" for i in range(200)]
    for i in range(50):  # one form letter, other names in 5 % of the words
        words[1000 + i] = [f"n{i}x{k}" if k % 20 == 0 else w for k, w in enumerate(form)]
    ids, codes = sorted(words), {}
    coded = {i: np.array([codes.setdefault(x, len(codes)) for x in w], np.uint64) for i, w in words.items()}
    want = {i: i for i in ids}
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if jaccard(words[a], words[b]) >= 0.8 and om.similarity(coded[a], coded[b]) >= 0.8:
                low, high = sorted((want[a], want[b]))
                want = {i: low if c == high else c for i, c in want.items()}
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in words.items()], "doc_id bigint, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in om.find_groups(docs, shingles=om.SIMILARITY).collect()}
    assert got == want and all(want[1000 + i] == 1000 + i for i in range(50)) and len(set(want.values())) < len(ids)


def test_recall_just_above_the_threshold(spark):
    rng = random.Random(12)
    rows, want = [], set()
    for n in range(400):
        a = [f"p{n}x{i}" for i in range(300)]
        b = list(a)
        for k in rng.sample(range(2, 298, 6), rng.choice([6, 7])):  # six: 266 of 326 shingles, seven: 261 of 331
            b[k] = "other" + b[k]
        if jaccard(a, b) >= 0.8:
            want.add(2 * n)
        rows += [(2 * n, " ".join(a)), (2 * n + 1, " ".join(b))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in om.find_groups(docs, shingles=om.SIMILARITY).collect()}
    found = {a for a in got if a % 2 == 0 and got[a + 1] == a}
    assert found <= want and len(want - found) <= 1 and 150 < len(want) < 250
    assert all(c == i or i % 2 and c == i - 1 for i, c in got.items())
    a = np.arange(300, dtype=np.uint64)
    swapped = np.concatenate([a[150:], a[:150]])
    assert om.shingle_similarity(a, swapped) > 0.95 and om.linked(a, swapped, 0.8, 0.8) == 0.0  # order counts


def test_prefixes_of_similar_texts_meet():
    rng = random.Random(15)
    often = np.array([rng.randint(0, 3) for _ in range(64)])
    met = 0
    for _ in range(2000):
        a = [rng.randint(0, 30) for _ in range(rng.randint(1, 60))]
        b = list(a)
        for _ in range(rng.randint(0, 2)):
            k = rng.randrange(len(b))
            b[k:k + 1] = [rng.randint(0, 30)] * rng.randint(1, 2)
        x, y = np.array(a, np.uint64), np.array(b, np.uint64)
        if not om.shingle_similarity(x, y, 0.8):
            continue
        met += 1
        (p, m), (q, n) = om.prefix(x, often, 0.8), om.prefix(y, often, 0.8)
        i = next(i for i, h in enumerate(p.tolist()) if h in q.tolist())  # the first shingle that both have
        j = q.tolist().index(p[i])
        assert min(m - i, n - j) >= 0.8 / 1.8 * (m + n) - 1e-6
    assert met > 300


def test_a_template_with_other_words_makes_no_pairs(spark, monkeypatch):
    """A bucket of a template whose copies are too far apart is left without a pair."""
    monkeypatch.setattr(om, "SMALL", 5)
    form = [f"f{i}" for i in range(200)]
    rows = [(i, " ".join(f"n{i}x{k}" if k % 32 == 0 else w for k, w in enumerate(form))) for i in range(60)]  # shingles 0.73
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    keys = om.sketched(docs, "doc_id", "text", om.SKETCHES, om.LENGTH).select("id", om.F.explode("keys").alias("bucket"))
    members = om._shared(keys.distinct().withColumn("m", om.F.lit(0)).withColumn("rest", om.F.lit(0)))
    assert members.groupBy("bucket").count().agg(om.F.max("count")).first()[0] > 20
    dealt = om._by_prefix(members, om.word_rows(docs, members.select("id").distinct(), "doc_id", "text"), 0.8)
    large = dealt.filter("m > 0")
    pairs, _ = om._round_pairs(om._with_labels(large, None), None, 1000, 0.8)
    assert pairs.count() == 0
    assert all(r.doc_id == r.component_id for r in om.find_groups(docs).collect())


def test_outlines_bound_the_shared_shingles():
    rng = np.random.default_rng(12)
    for _ in range(200):
        a = rng.integers(0, 40, rng.integers(0, 300)).astype(np.uint64)
        b = np.concatenate([a[:rng.integers(0, len(a) + 1)], rng.integers(0, 40, rng.integers(0, 30)).astype(np.uint64)])
        x, y = (np.frombuffer(om.outline(w), np.uint8).astype(int) for w in (a, b))
        shared = np.intersect1d(*(om.labelled(om.shingle_hashes(w)) for w in (a, b)))
        assert x.sum() == max(1, len(a) - om.SHINGLE + 1) and np.minimum(x, y).sum() >= len(shared)
    assert om.outline(np.arange(200_000, dtype=np.uint64)) is None


def test_possible_pairs_lose_none(spark):
    rng = np.random.default_rng(13)
    base = rng.integers(0, 10**6, 200).astype(np.uint64)
    texts = []
    for i in range(40):
        w = base.copy()
        at = rng.choice(200, i, replace=False)
        w[at] = rng.integers(10**6, 10**7, i)
        texts.append(w)
    texts.append(np.arange(70_000, dtype=np.uint64) % 7)  # counts over a byte: no outline, always possible
    words = spark.createDataFrame([(i, bytearray(w.tobytes()), (lambda o: o and bytearray(o))(om.outline(w))) for i, w in enumerate(texts)],
                                  "id bigint, words binary, outline binary")
    assert om.outline(texts[-1]) is None
    every = [(a, b) for a in range(len(texts)) for b in range(a + 1, len(texts))]
    got = {tuple(r) for r in om._possible(spark.createDataFrame(every, "a bigint, b bigint"), words, 0.8).collect()}
    true = {(a, b) for a, b in every if om.shingle_similarity(texts[a], texts[b], 0.8)}
    assert true and true <= got and {(a, 40) for a in range(40)} <= got
    assert len(got) < len(every) // 2


def test_components_read_a_dense_group_twice(spark, monkeypatch):
    """Links inside one class vanish after the first round, so that later rounds read the few that are left."""
    from propensity.llm import components as module
    links = [(i, j) for i in range(40) for j in range(i)] + [(i, i + 1) for i in range(100, 140)] + [(7, 7), (500, 500), (None, 3)]
    links += [(39, 1000 + i) for i in range(30)] + [(2000, 2001 + i) for i in range(5)] + [(1029, 2005)]
    written = []

    def counted(df):
        out = df.localCheckpoint()
        if out.columns == ["a", "b"]:
            written.append(out.count())
        return out

    monkeypatch.setattr(module, "keep", counted)
    got = {r.id: r.component for r in module.components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {**{i: 0 for i in [*range(40), *range(1000, 1030), *range(2000, 2006)]}, **{i: 100 for i in range(100, 141)}, 500: 500}
    assert got == want and written[0] > 800 and sum(written[1:]) < 60


def test_texts_that_are_not_compared_are_not_shuffled(spark):
    docs = spark.createDataFrame([(i, f"w{i} some words of text {i % 7}") for i in range(3000)] + [(None, "no id"), (5, None)], "doc_id long, text string")
    wanted = spark.createDataFrame([(i,) for i in (0, 3, 5, 2999, 40000)], "id long")
    rows = om.word_rows(docs, wanted, "doc_id", "text")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("LeftSemi") < plan.index("MapInArrow")  # the join reads what the tasks on the texts gave
    got = {r.id: len(r.words) // 8 for r in rows.collect()}
    assert got == {0: 6, 3: 6, 5: 0, 2999: 6}
    marks = om._marks(wanted)
    assert np.unpackbits(marks).sum() == 5


def test_parities_bound_the_shingles_that_one_text_has():
    rng = np.random.default_rng(21)
    for _ in range(200):
        a = rng.integers(0, 40, rng.integers(0, 300)).astype(np.uint64)
        b = np.concatenate([a[:rng.integers(0, len(a) + 1)], rng.integers(0, 40, rng.integers(0, 30)).astype(np.uint64)])
        differ = sum(int(v).bit_count() for v in (om.parity(a) ^ om.parity(b)).view(np.uint64))
        assert differ <= len(np.setxor1d(*(om.labelled(om.shingle_hashes(w)) for w in (a, b))))


def test_a_large_bucket_makes_no_pairs_that_are_far_apart(spark, monkeypatch):
    """Before, each leader met every member of its bucket."""
    monkeypatch.setattr(om, "SMALL", 5)
    form = [f"f{i}" for i in range(200)]
    rows = [(i, " ".join(f"n{i}x{k}" if k % 16 == 5 else w for k, w in enumerate(form))) for i in range(0, 60, 2)]
    rows += [(i + 1, t + " end") for i, t in rows]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    words = om.word_rows(docs, docs.select(om.F.col("doc_id").alias("id")), "doc_id", "text")
    one = words.selectExpr("id", "1L AS bucket", "196 AS m", "196 AS rest")
    pairs, _ = om._round_pairs(om._with_labels(one, None), None, 1000, 0.8, words)
    assert sorted(map(tuple, pairs.collect())) == [(i, i + 1) for i in range(0, 60, 2)]


def test_shingles_of_one_prefix_make_no_rows(spark):
    rng = np.random.default_rng(22)
    base = rng.integers(0, 10**6, 100).astype(np.uint64)
    texts = [np.concatenate([rng.integers(10**6, 10**12, 100).astype(np.uint64), base[:20 * (i % 2)]]) for i in range(30)]
    rows = spark.createDataFrame([(i, bytearray(w.tobytes())) for i, w in enumerate(texts)], "id bigint, words binary").repartition(3)
    often = np.zeros(16, np.int64)
    marks = om._repeated(rows, often, 0.5)
    found = np.concatenate([om.prefix(w, often, 0.5)[0] for w in texts])
    at = om._slots(found)
    twice = np.unpackbits(marks)[at] == 1
    values, n = np.unique(found, return_counts=True)
    assert twice[np.isin(found, values[n > 1])].all() and (n > 1).any()
    assert np.unpackbits(marks).sum() < 1.2 * (n > 1).sum() + 3
