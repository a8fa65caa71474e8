"""Trees from histograms: against plain Python, and the same in both ways of running."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from propensity.operators import boosting as B


def frame(spark, n=400, parts=3, seed=5):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.integers(0, 9, n), rng.integers(0, 4, n), np.round(rng.standard_normal(n), 1), rng.integers(0, 2, n)], axis=1).astype(float)
    p = 1 / (1 + np.exp(-(x[:, 0] - 4 + 2 * x[:, 3] * (x[:, 1] > 1))))
    y = (rng.random(n) < p).astype(int)
    rows = [(i, Vectors.dense(v), int(t), i % 4) for i, (v, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, ["id", "features", "label", "fold"]).repartition(parts), x, y


def equal(a, b):
    assert a.base == pytest.approx(b.base, abs=1e-9) and len(a.trees) == len(b.trees)
    for s, t in zip(a.trees, b.trees):
        for c in s:
            np.testing.assert_allclose(s[c], t[c], rtol=1e-9, atol=1e-9)


SPECS = {
    "xgb": B.Spec(rounds=4, depth=3, eta=0.3, l2=1.0, l1=0.1, gamma=0.05, min_weight=1.0, row_share=0.8, columns=0.8),
    "gbm": B.Spec(rounds=3, depth=2, eta=0.3, min_rows=5, row_share=0.7, second_order=False, from_mean=True),
    "lgb": B.Spec(rounds=3, depth=None, leaves=7, eta=0.3, l2=1.0, min_rows=5, row_share=0.8, bag_every=2),
    "forest": B.Spec(rounds=7, depth=4, min_rows=3, forest=True, columns=2),
}


def test_both_ways_give_the_same_trees(spark):
    df, _, _ = frame(spark)
    data = B.bin_rows(df, "id", fold="fold")
    jobs = [B.Job(s, held) for s in SPECS.values() for held in (-2, 1)]
    local, spread = B.fit_local(data, jobs, trees_per_task=3), B.fit_spread(data, jobs, part_rows=90)
    for a, b in zip(local, spread):
        equal(a, b)
    again = B.fit_local(B.bin_rows(df.repartition(7), "id", fold="fold"), jobs)
    for a, b in zip(local, again):
        equal(a, b)


def brute_split(x, g, h, l2, gamma):
    best = (0.0, None, None)
    for f in range(x.shape[1]):
        for v in sorted(set(x[:, f]))[:-1]:
            m = x[:, f] <= v
            gain = 0.5 * (g[m].sum() ** 2 / (h[m].sum() + l2) + g[~m].sum() ** 2 / (h[~m].sum() + l2) - g.sum() ** 2 / (h.sum() + l2)) - gamma
            if gain > best[0] + 1e-6:
                best = (gain, f, v)
    return best


def test_leaf_wise_equals_brute_force(spark):
    """Best leaf first: every split is the largest gain of all open leaves, up to the leaf budget."""
    df, x, y = frame(spark, 200)
    spec = B.Spec(rounds=1, depth=None, leaves=6, eta=1.0, l2=1.0)
    model = B.fit_trees(B.bin_rows(df, "id", bins=255), [B.Job(spec)])[0]
    g, h = 0.5 - y, np.full(len(y), 0.25)
    leaves = [np.ones(len(y), bool)]
    while len(leaves) < 6:
        found = [brute_split(x[m], g[m], h[m], 1.0, 0.0) for m in leaves]
        k = max(range(len(leaves)), key=lambda i: found[i][0])
        if found[k][1] is None:
            break
        m = leaves.pop(k)
        side = x[:, found[k][1]] <= found[k][2]
        leaves += [m & side, m & ~side]
    want = np.zeros(len(y))
    for m in leaves:
        want[m] = -g[m].sum() / (h[m].sum() + 1.0)
    got = model.leaf_values(model.binned(x))[0]
    np.testing.assert_allclose(got, want, atol=1e-4)
    assert (model.trees[0]["left"] < 0).sum() == 6


def test_gamma_weight_and_depth_stop_growth(spark):
    df, _, _ = frame(spark, 200)
    data = B.bin_rows(df, "id")
    small, none, heavy = B.fit_trees(data, [B.Job(B.Spec(rounds=1, depth=2)), B.Job(B.Spec(rounds=1, gamma=1e9)), B.Job(B.Spec(rounds=1, min_weight=1e9))])
    assert len(small.trees[0]["left"]) <= 7 and len(none.trees[0]["left"]) == len(heavy.trees[0]["left"]) == 1


def test_scores_and_held_out_rows(spark):
    df, x, y = frame(spark, 400)
    data = B.bin_rows(df, "id", fold="fold")
    model, other = B.fit_trees(data, [B.Job(SPECS["xgb"]), B.Job(SPECS["xgb"], 1)])
    scored = sorted((r.id, r.prob) for r in model.score(df).collect())
    np.testing.assert_allclose([p for _, p in scored], model.predict(model.binned(x)))
    assert np.mean((model.predict(model.binned(x)) > 0.5) == y) > 0.7
    # changing the labels of a fold does not change the model that holds it out
    flipped = df.withColumn("label", (df.label + (df.fold == 1).cast("int")) % 2)
    equal(other, B.fit_trees(B.bin_rows(flipped, "id", fold="fold"), [B.Job(SPECS["xgb"], 1)])[0])


def test_one_class_and_constant_features(spark):
    df = spark.createDataFrame([(i, Vectors.dense([1.0, 2.0]), 1) for i in range(30)], ["id", "features", "label"])
    for m in B.fit_trees(B.bin_rows(df, "id"), [B.Job(s) for s in SPECS.values()]):
        assert all(len(t["left"]) == 1 for t in m.trees) and (m.predict(np.zeros((2, 2), np.uint8)) > 0.5).all()
    with pytest.raises(ValueError):
        B.fit_trees(B.bin_rows(df.limit(0), "id"), [B.Job(SPECS["gbm"])])


def test_bags_are_poisson():
    counts = B.bag(np.arange(0, B.PRIME, 20011), B.Spec(forest=True), 3)
    assert counts.mean() == pytest.approx(1, abs=0.02) and (counts == 0).mean() == pytest.approx(np.exp(-1), abs=0.01)
