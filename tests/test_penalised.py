"""Penalty paths: optimality of every fit, the chosen penalty, folds, and edge cases."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from propensity.operators import boosting as B
from propensity.operators import penalised as P


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((600, 6)) * [1, 5, 0.1, 1, 1, 0] + [0, 3, 0, 0, 0, 2]
    y = (rng.random(600) < 1 / (1 + np.exp(-(1.5 * x[:, 0] - 0.3 * (x[:, 1] - 3))))).astype(int)
    df = spark.createDataFrame([(i, Vectors.dense(v), int(t), i % 3) for i, (v, t) in enumerate(zip(x, y))], ["id", "features", "label", "fold"])
    return df, x, y


def gradient(path, k, x, y):
    p = 1 / (1 + np.exp(-(path.intercepts[k] + x @ path.coefficients[k])))
    sd = x.std(axis=0)
    return ((y - p) @ (x - x.mean(axis=0))) / len(y) / np.where(sd > 0, sd, np.inf), (y - p).mean()


def test_every_penalty_is_optimal(rows):
    df, x, y = rows
    path = P.penalty_paths(B.bin_rows(df, "id"), n_penalties=20)[0]
    assert (path.coefficients[0] == 0).all()
    for k in range(20):
        g, g0 = gradient(path, k, x, y)
        on = path.coefficients[k] != 0
        assert abs(g0) < 1e-3
        np.testing.assert_allclose(g[on], path.penalties[k] * np.sign(path.coefficients[k][on]), atol=1e-3)
        assert (np.abs(g[~on]) <= path.penalties[k] + 1e-3).all()
    assert (path.coefficients[:, 5] == 0).all()


def test_the_model_carries_the_chosen_penalty(spark, rows):
    df, x, _ = rows
    path = P.penalty_paths(B.bin_rows(df, "id"), n_penalties=30)[0]
    model = path.model()
    assert model.penalty == path.penalties[path.smallest] and path.auc[path.smallest] == pytest.approx(path.auc.max())
    assert path.sparse <= path.smallest and path.auc[path.sparse] >= path.auc.max() - path.error[path.smallest]
    table = path.table(spark).collect()
    assert [r["lambda"] for r in table if r.is_min] == [model.penalty] and sum(r.is_1se for r in table) == 1
    got = {r.id: r.prob for r in model.score(df).collect()}
    np.testing.assert_allclose([got[i] for i in range(600)], 1 / (1 + np.exp(-(model.intercept + x @ model.coefficients))))


def test_held_out_rows_have_no_say(rows):
    df, x, y = rows
    both = P.penalty_paths(B.bin_rows(df, "id", fold="fold"), held=(-2, 1), n_penalties=8)
    alone = P.penalty_paths(B.bin_rows(df.filter("fold <> 1"), "id"), n_penalties=8)[0]
    np.testing.assert_allclose(both[1].coefficients, alone.coefficients, atol=1e-4)
    np.testing.assert_allclose(both[1].auc, alone.auc, atol=1e-6)


def test_ridge_and_one_class(spark, rows):
    df, x, y = rows
    data = B.bin_rows(df, "id")
    ridge, lasso = P.penalty_paths(data, alphas=(0.0, 1.0), n_penalties=5)
    assert (ridge.coefficients[-1][:5] != 0).all() and (lasso.coefficients[0] == 0).all()
    np.testing.assert_allclose(lasso.coefficients, P.penalty_paths(data, n_penalties=5)[0].coefficients, atol=1e-6)
    one = P.penalty_paths(B.bin_rows(df.filter("label = 1"), "id"), n_penalties=5)[0]
    assert (one.coefficients == 0).all() and np.isfinite(one.intercepts).all() and (one.auc == 0.5).all()


def test_area():
    counts = np.array([[3.0, 1.0, 0.0], [0.0, 1.0, 4.0]])
    assert P.area(counts) == pytest.approx((1 * (3 + 0.5) + 4 * 4) / 20)
