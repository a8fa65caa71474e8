"""Cost-complexity pruning against all subtrees of a small tree, and hash samples."""

import itertools
import math

import numpy as np
import pytest

from propensity.operators import boosting as B
from propensity.operators import pruning as P
from propensity.operators import sampling
from tests.test_boosting import frame


def by_hand():
    """Root 0 (40 of 100 positive), its children 1 and 2, leaves 3 to 6."""
    rows = np.array([100.0, 60, 40, 30, 30, 20, 20])
    pos = np.array([40.0, 10, 30, 2, 8, 12, 18])
    left, right = np.array([1, 3, 5, -1, -1, -1, -1]), np.array([2, 4, 6, -1, -1, -1, -1])
    inner = left >= 0
    return {"feature": np.where(inner, 0, -1), "bin": np.where(inner, 1, -1), "value": pos / rows, "cover": rows, "rows": rows,
            "left": left, "right": right, "gain": inner * 1.0}


def test_path_by_hand():
    # risks: 40 at the root, 10 and 10 at the children, whose splits save nothing: they go at price 0
    got = P.weakest_links(by_hand())
    assert [(round(p, 12), inner.sum()) for p, inner in got] == [(0.0, 1), (0.5, 0)]
    assert P.subtree(by_hand(), got[0][1])["left"].tolist() == [1, -1, -1]


def all_subtrees(tree):
    inner = [n for n in range(len(tree["left"])) if tree["left"][n] >= 0]
    parent = {int(c): n for n in inner for c in (tree["left"][n], tree["right"][n])}
    for k in range(len(inner) + 1):
        for chosen in itertools.combinations(inner, k):
            if all(n == 0 or parent[n] in chosen for n in chosen):
                yield chosen


def test_every_subtree_of_the_path_is_the_best_at_its_price(spark):
    df, _, _ = frame(spark, 400)
    spec = B.Spec(rounds=1, depth=4, min_rows=5, forest=True, bagged=False, columns=1e9)
    tree = B.fit_trees(B.bin_rows(df, "id"), [B.Job(spec)])[0].trees[0]
    risk = P.node_risk(tree)
    shapes = []
    for chosen in all_subtrees(tree):
        inner = np.isin(np.arange(len(risk)), chosen)
        part = P.subtree(tree, inner)
        shapes.append((P.node_risk(part)[part["left"] < 0].sum() / risk[0], len(chosen)))
    path = P.weakest_links(tree)
    assert len(path) > 2 and path[-1][1].sum() == 0 and [p for p, _ in path] == sorted(p for p, _ in path)
    ends = [p for p, _ in path[1:]] + [path[-1][0] * 2 + 1]
    for (p, inner), end in zip(path, ends):
        for price in (p, (p + end) / 2):
            least = min(r + price * k for r, k in shapes)
            size = min(k for r, k in shapes if r + price * k <= least + 1e-9)
            assert size == inner.sum()


def test_cross_validated_errors(spark):
    df, x, y = frame(spark, 400)
    data = B.bin_rows(df, "id", fold="fold")
    path = P.pruning_path(data, 4, least=0.002)
    assert [r[1] for r in path.rows] == sorted(r[1] for r in path.rows) and path.rows[0][1:3] == (0, 1.0)
    links = dict((int(i.sum()), p) for p, i in P.weakest_links(path.full.trees[0]))
    prices = {r[1]: max(links[r[1]], 0.002) for r in path.rows}
    above = [math.inf] + [r[0] for r in path.rows]
    held = B.fit_trees(data, [B.Job(P.TREE, f) for f in range(4)])
    root = min(y.sum(), len(y) - y.sum())
    for r, end in zip(path.rows, above):
        assert r[0] == pytest.approx(prices[r[1]])
        wrong = 0
        for f in range(4):
            at = np.arange(400) % 4 == f
            model = P.pruned(held[f], math.sqrt(r[0] * end))
            wrong += ((model.predict(model.binned(x[at])) >= 0.5) != y[at]).sum()
        assert r[3] == pytest.approx(wrong / root)
        assert r[4] == pytest.approx(math.sqrt(wrong - wrong ** 2 / 400) / root)
    rows = path.table(spark).collect()
    assert sum(r.is_smallest for r in rows) == sum(r.is_one_error for r in rows) == 1
    chosen, simple = (next(r for r in rows if getattr(r, c)) for c in ("is_smallest", "is_one_error"))
    assert simple.n_splits <= chosen.n_splits and simple.xerror <= chosen.xerror + chosen.xstd
    part = path.model().trees[0]
    assert (part["left"] >= 0).sum() == chosen.n_splits
    assert P.pruned(path.full, 0.002).score(df).filter("prob is null").count() == 0


def test_one_class_and_no_rows(spark):
    df, _, _ = frame(spark, 60)
    path = P.pruning_path(B.bin_rows(df.withColumn("label", df.label * 0), "id", fold="fold"), 4)
    assert path.rows == [(0.01, 0, 0.0, 0.0, 0.0)]
    assert P.pruning_path(B.bin_rows(df.limit(0), "id", fold="fold"), 4).rows == [(0.01, 0, 0.0, 0.0, 0.0)]


def test_fraction_samples_depend_on_keys_only(spark):
    df = spark.range(20000).withColumnRenamed("id", "k")
    once = {r.k for r in sampling.fraction_sample(df, "k", 0.3).collect()}
    assert 5700 < len(once) < 6300
    assert once == {r.k for r in sampling.fraction_sample(df.repartition(13), "k", 0.3).collect()}
    many = sampling.fraction_sample(df, "k", 2.0, True).groupBy("k").count()
    counts = {r["count"]: r["n"] for r in many.groupBy("count").agg({"k": "count"}).withColumnRenamed("count(k)", "n").collect()}
    assert sum(c * n for c, n in counts.items()) == pytest.approx(40000, rel=0.03)
    assert counts[2] / 20000 == pytest.approx(2 * math.exp(-2), abs=0.02) and 0 not in counts
    nulls = spark.createDataFrame([(None,), (1,)], "k bigint")
    assert sampling.fraction_sample(nulls, "k", 1.0).count() == 1
    assert sampling.fraction_sample(nulls, "k", 50.0, True).filter("k is null").count() == 0
