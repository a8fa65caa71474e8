"""Fits of large tables: one task a fit, groups of features counted together, leaves by masks, prefixes in one walk."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from propensity.operators import boosting as B
from propensity.operators import models as M
from propensity.operators import penalised as P
from propensity.operators import tuning as T


def made(n=3000, seed=3, weights=False):
    rng = np.random.default_rng(seed)
    widths = np.array([40, 2, 1, 7, 64, 2, 2, 30])
    bins = np.stack([rng.integers(0, w, n) for w in widths], axis=1).astype(np.uint8)
    y = (rng.random(n) < 1 / (1 + np.exp(-(bins[:, 0] / 10 - 2 + bins[:, 1] - (bins[:, 4] > 40))))).astype(float)
    w = rng.choice([0.5, 1.0, 700.0], n) if weights else np.ones(n)
    return B.Rows(bins, y, w, rng.integers(0, B.PRIME, n), np.zeros(n, np.int64)), widths


def frame(spark, n=300):
    rng = np.random.default_rng(8)
    x = np.stack([rng.integers(0, 9, n), rng.standard_normal(n), rng.integers(0, 2, n)], axis=1)
    y = (rng.random(n) < 1 / (1 + np.exp(4 - x[:, 0] - x[:, 2]))).astype(int)
    return spark.createDataFrame([(i, Vectors.dense(v), int(t)) for i, (v, t) in enumerate(zip(x, y))], ["id", "features", "label"]), x, y


def test_a_fit_of_six_hundred_thousand_rows_is_a_task(spark, monkeypatch):
    """Rounds of a booster do not wait for a job of the whole cluster each."""
    df, _, _ = frame(spark)
    data = replace(B.bin_rows(df, "id"), n_rows=630_000)
    for way in ("local", "spread"):
        monkeypatch.setattr(B, f"fit_{way}", lambda *_, way=way: way)
    assert B.fit_trees(data, [B.Job(B.SPECS[n], f) for n in B.SPECS for f in range(5)]) == "local"
    assert B.fit_trees(replace(data, n_rows=B.LOCAL_ROWS + 1), [B.Job(B.SPECS["boosted"])]) == "spread"


@pytest.mark.parametrize("weights", [False, True])
@pytest.mark.parametrize("spec", [B.Spec(depth=4, row_share=0.8), B.Spec(forest=True, columns=3)])
def test_groups_give_the_sums_of_every_bin(monkeypatch, weights, spec):
    rows, widths = made(weights=weights)
    monkeypatch.setattr(B, "COUNTED", 256)
    margin = None if spec.forest else np.linspace(-2, 2, len(rows.y))
    times = B.bag(rows.number, spec, 5)
    at = np.flatnonzero(times)
    groups = B.Groups(widths)
    assert len(groups.groups) < len(widths) and sorted(f for g in groups.groups for f in g) == list(range(len(widths)))
    part = B.Rows(None, rows.y[at], rows.w[at], None, None)
    g, h = B.derivatives(part, None if margin is None else margin[at], spec, part.w * times[at])
    got = B.Counter(groups, groups.codes(rows.bins[at]), g, h, times[at], spec.forest).count([0])
    ask = replace(B.Tree(spec, 5).ask(len(widths)), columns=np.arange(len(widths))[None])
    want = B.histogram(rows, margin, spec, -2, ask, widths)
    assert (got[:, ask.cells(widths)] == want).all()


def test_leaves_by_masks_are_those_of_a_walk():
    rows, widths = made(4000)
    spec = B.Spec(rounds=1, depth=9, forest=True, columns=4)
    _, (tree,) = B.grow_all(replace(rows), B.Job(spec), widths, range(1))
    groups = B.Groups(widths)
    assert (tree["left"] < 0).sum() > 64
    got = np.concatenate([nodes for _, nodes in B.Leaves(tree, groups).nodes(groups.codes(rows.bins))])
    assert (got == B.walk(rows.bins, tree["feature"], tree["bin"], tree["left"], tree["right"])).all()


def test_masks_and_walks_grow_the_same_trees(monkeypatch):
    rows, widths = made()
    for spec in (B.Spec(rounds=3, depth=4, eta=0.3, l2=1.0, row_share=0.7, columns=0.5), B.Spec(rounds=3, depth=None, leaves=9, bag_every=2, row_share=0.5)):
        grown = []
        for least in (10 ** 9, 1):
            monkeypatch.setattr(B, "MASKED", least)
            grown.append(B.grow_all(replace(rows), B.Job(spec), widths, range(3))[1])
        for a, b in zip(*grown):
            assert all((a[c] == b[c]).all() for c in a)


def test_prefixes_and_depths_share_a_walk():
    rows, widths = made()
    for spec in (B.Spec(rounds=4, depth=5, eta=0.3), B.Spec(rounds=4, depth=5, forest=True, columns=3)):
        base, trees = B.grow_all(replace(rows), B.Job(spec), widths, range(4))
        model = B.TreeModel(spec, [], trees, base)
        cuts = [(None, None), (2, 3), (4, 3), (9, 0), (2, None)]
        for (n, depth), got in zip(cuts, model.predictions(rows.bins, cuts)):
            values = [t["value"][B.walk(rows.bins, t["feature"], t["bin"], t["left"], t["right"], depth)] for t in trees[:n]]
            want = sum(values) / len(values) if spec.forest else 1 / (1 + np.exp(-(base + sum(values))))
            np.testing.assert_allclose(got, want, rtol=1e-12)


def test_fold_that_holds_out_all_rows(spark):
    df, _, _ = frame(spark, 60)
    data = B.bin_rows(df.selectExpr("*", "1 AS fold"), "id", fold="fold")
    none, every = B.fit_local(data, [B.Job(B.Spec(rounds=2, depth=2), 1), B.Job(B.Spec(rounds=2, depth=2), 0)])
    assert [len(t["left"]) for t in none.trees] == [1, 1] and len(every.trees[0]["left"]) > 1


def test_hold_out_grid_fits_sizes_once(spark, monkeypatch):
    """Candidates that differ in their number of trees are one fit; error and Brier score are those of the forest."""
    df, x, y = frame(spark)
    asked = []
    monkeypatch.setattr(T, "fit_trees", lambda data, jobs: asked.extend(jobs) or B.fit_trees(data, jobs))
    monkeypatch.setattr(T, "fit_many", None)
    grid = T.combinations({"numTrees": [3, 6], "featureSubsetStrategy": ["2", "3"], "minInstancesPerNode": [1, 10]})
    got = T.brier_search(df, df, "forest", grid, "id").collect()
    assert len(asked) == 4 and len(got) == 8 and sum(r.is_best for r in got) == 1
    model = B.fit_trees(B.bin_rows(df, "id"), [B.Job(B.Spec(rounds=3, depth=8, min_rows=10, row_share=0.8, columns=2, forest=True))])[0]
    p = model.predict(model.binned(x))
    row = next(r for r in got if r.params == "numTrees=3, featureSubsetStrategy=2, minInstancesPerNode=10")
    assert row.brier == pytest.approx(((p - y) ** 2).mean()) and row.error == pytest.approx(((p >= 0.5) != (y == 1)).mean())
    assert min(r.brier for r in got) == next(r.brier for r in got if r.is_best)


def test_blocks_of_the_recommender_follow_the_ratings(spark, monkeypatch):
    seen = []

    class Learner:
        def __init__(self, **settings):
            seen.append(settings)

        def fit(self, _):
            return None

    monkeypatch.setattr(M, "ALS", Learner)
    monkeypatch.setattr(M, "BLOCK_RATINGS", 20)
    for n in (5, 1000):
        M.fit_recommender(spark.range(n))
    assert [(s["numUserBlocks"], s["numItemBlocks"]) for s in seen] == [(10, 10), (50, 50)]


def test_moments_of_a_step():
    rng = np.random.default_rng(2)
    x, w = rng.standard_normal((1500, 3)), rng.choice([0.0, 1.0, 2.5], 1500)
    y, number, fold = (rng.random(1500) < 0.4).astype(float), rng.integers(0, 10 ** 6, 1500), rng.integers(0, 3, 1500)
    beta = rng.standard_normal((1, 2, 4))
    got = P._steps((x, y, w, number, fold), [(1, 0, 1.0)], beta, np.zeros((1, 3)), np.ones((1, 3)), 5)[0]
    v = w * (fold != 1) * (P.inner_fold(number, 5) != 0)
    z = np.column_stack([np.ones(1500), x])
    for k in range(2):
        p = 1 / (1 + np.exp(-z @ beta[0, k]))
        s = p * (1 - p) * v
        np.testing.assert_allclose(got[k, :16].reshape(4, 4), (z * s[:, None]).T @ z, rtol=1e-9)
        np.testing.assert_allclose(got[k, 16:], z.T @ ((y - p) * v + s * (z @ beta[0, k])), rtol=1e-9, atol=1e-9)


def test_forests_on_amounts(spark, monkeypatch):
    """One pass for all folds and sets; depths are cuts of one fit; leaves are means in the label's own unit."""
    df, x, _ = frame(spark)
    amounts = df.withColumn("label", df.label * 30000.25 + df.id * 10).drop("fold")
    asked = []
    monkeypatch.setattr(M.B, "fit_trees", lambda data, jobs, fit=B.fit_trees: asked.append(jobs) or fit(data, jobs))
    grid = T.combinations({"maxDepth": [1, 4], "minInstancesPerNode": [2, 40], "numTrees": [6]})
    best, table, plain = T.amount_search(amounts, "id", "loan_forest", grid, 3)
    rows = table.collect()
    assert [len(jobs) for jobs in asked] == [6, 2] and len(plain.trees) == 200 and plain.spec.depth == 5 and plain.spec.columns == 1
    assert len(rows) == 4 and rows[0].is_best and rows[0].metric == min(r.metric for r in rows) < rows[-1].metric
    y = np.array([r.label for r in amounts.orderBy("id").collect()])
    (tree,) = M.fit_amounts(*M.bin_amounts(amounts, "id"), [B.Job(B.Spec(rounds=1, depth=0, forest=True, columns=1, bagged=False))])[0].trees
    assert tree["value"][0] == pytest.approx(y.mean(), rel=1e-6)
    assert np.corrcoef(best.predict(best.binned(x)), y)[0, 1] > 0.5


def test_the_first_penalty_leaves_nothing_in_any_order(spark):
    rng = np.random.default_rng(6)
    x = rng.standard_normal((200, 3))
    rows = [(i, Vectors.dense(v), int(t)) for i, (v, t) in enumerate(zip(x, rng.random(200) < 1 / (1 + np.exp(-x[:, 0]))))]
    for order in range(4):
        df = spark.createDataFrame([rows[i] for i in rng.permutation(200)], ["id", "features", "label"]).selectExpr(f"id * {7 * order + 1} AS id", "features", "label")
        assert (P.penalty_paths(B.bin_rows(df, "id"), n_penalties=3, steps=4)[0].coefficients[0] == 0).all()
