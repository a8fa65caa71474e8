"""Out-of-bag measures against plain loops, and exact Shapley values against all subsets."""

import itertools
import math

import numpy as np
import pytest

from propensity.operators import boosting as B
from propensity.operators import outofbag as O
from propensity.operators import treeshap as S
from tests.test_boosting import frame


@pytest.fixture(scope="module")
def forest(spark):
    df, x, y = frame(spark, 300)
    data = B.bin_rows(df, "id")
    model = B.fit_trees(data, [B.Job(B.Spec(rounds=25, depth=4, min_rows=3, forest=True, columns=2))])[0]
    return data, model, x, y


def plain_votes(data, model):
    rows = sorted(data.rows.select("key", "bins", "y", "number").collect())
    out = {}
    for r in rows:
        bins = np.frombuffer(r.bins, np.uint8)[None]
        out[r.key] = (r.y, [(model.leaf_values(bins)[t, 0] >= 0.5) if B.bag(np.array([r.number]), model.spec, t)[0] == 0 else None
                            for t in range(len(model.trees))])
    return out


def test_votes_and_error_curve(forest):
    data, model, _, _ = forest
    want = plain_votes(data, model)
    for r in O.votes(data, model).collect():
        seen = [v for v in want[r.id][1] if v is not None]
        assert r.n_trees == len(seen) and r.vote_share == (pytest.approx(sum(seen) / len(seen)) if seen else None)
    curve = {r.trees: r for r in O.error_by_trees(data, model).collect()}
    for t in (1, 7, 25):
        judged = [(y, [v for v in vs[:t] if v is not None]) for y, vs in want.values()]
        wrong = [(2 * sum(v) >= len(v)) != (y == 1) for y, v in judged if v]
        assert curve[t].error == pytest.approx(sum(wrong) / len(wrong))
    assert sum(r.is_best for r in curve.values()) == 1
    grid = {r.trees: r for r in O.grid_errors(data, [model], [7, 25]).collect()}
    assert 0 < grid[25].brier < 0.25


def test_importance_finds_the_signal(forest):
    data, model, _, _ = forest
    got = {r.feature: r for r in O.permutation_importance(data, model, list("abcd")).collect()}
    assert max(got, key=lambda f: got[f].importance) == "a" and abs(got["c"].importance) < 0.05 and got["a"].scaled > 5


def test_first_trees_and_shallow_cuts_are_smaller_fits(spark, forest):
    data, model, x, _ = forest
    small = B.fit_trees(data, [B.Job(B.Spec(rounds=9, depth=2, min_rows=3, forest=True, columns=2))])[0]
    bins = model.binned(x)
    np.testing.assert_allclose(model.predict(bins, 9, 2), small.predict(bins))


def known_value(tree, n, bins, known):
    """Mean of the leaves by weight where a split's feature is not known."""
    if tree["left"][n] < 0:
        return tree["value"][n]
    a, b = tree["left"][n], tree["right"][n]
    if tree["feature"][n] in known:
        return known_value(tree, a if bins[tree["feature"][n]] <= tree["bin"][n] else b, bins, known)
    return sum(tree["cover"][c] / tree["cover"][n] * known_value(tree, c, bins, known) for c in (a, b))


@pytest.mark.parametrize("spec", [B.Spec(rounds=3, depth=3, eta=0.3, l2=1.0), B.Spec(rounds=3, depth=3, forest=True, columns=3),
                                  B.Spec(rounds=2, depth=None, leaves=12, eta=0.5, min_rows=2)])
def test_shapley_values_equal_all_subsets(spark, spec):
    df, x, _ = frame(spark, 120)
    model = B.fit_trees(B.bin_rows(df, "id"), [B.Job(spec)])[0]
    bins = model.binned(x)[:15]
    got = S.shares(model, bins)
    scale = len(model.trees) if spec.forest else 1
    for i, row in enumerate(bins):
        for f in range(4):
            others = [g for g in range(4) if g != f]
            want = sum(math.factorial(len(s)) * math.factorial(3 - len(s)) / 24 * (
                known_value(t, 0, row, {*s, f}) - known_value(t, 0, row, set(s)))
                for t in model.trees for k in range(4) for s in itertools.combinations(others, k)) / scale
            assert got[i, f] == pytest.approx(want, abs=1e-9)
    raw = model.predict(bins) if spec.forest else np.log(model.predict(bins) / (1 - model.predict(bins)))
    np.testing.assert_allclose(got.sum(axis=1) + S.mean_score(model), raw, atol=1e-9)
    rows = {(r.id, r.feature): r.value for r in S.shapley_values(model, df, "id", list("abcd")).collect()}
    assert len(rows) == 480 and rows[3, "b"] == pytest.approx(got[3, 1])


def test_shapley_values_without_tables_of_patterns(spark, monkeypatch):
    df, x, _ = frame(spark, 200)
    model = B.fit_trees(B.bin_rows(df, "id"), [B.Job(B.Spec(rounds=4, depth=4, eta=0.3, l2=1.0))])[0]
    bins = model.binned(x)
    tables = S.leaves(model)
    assert all(leaf.table is not None for leaf in tables)
    got = S.shares(model, bins, tables)
    monkeypatch.setattr(S, "TABLE", 0)
    assert all(leaf.table is None for leaf in S.leaves(model))
    np.testing.assert_allclose(S.shares(model, bins), got, atol=1e-12)


def test_shapley_tables_are_filled_once_per_task(spark, monkeypatch):
    """Results per pattern are worked out per leaf, not per batch of rows."""
    df, x, _ = frame(spark, 200)
    model = B.fit_trees(B.bin_rows(df, "id"), [B.Job(B.Spec(rounds=4, depth=4, eta=0.3, l2=1.0))])[0]
    tables, calls = S.leaves(model), []
    monkeypatch.setattr(S, "path_shares", lambda o, z: calls.append(1))
    for at in range(0, 200, 20):
        S.shares(model, model.binned(x)[at:at + 20], tables)
    assert not calls
