"""Embedding links against brute force, with recall measured."""

import numpy as np
import pytest

from propensity.llm import projections as pj


def brute(rows):
    ok = {}
    for i, e, l, _ in rows:
        if l is not None and e is not None and len(e) and all(x is not None and np.isfinite(x) for x in e) and any(e):
            ok[i] = (np.array(e, float), l)
    links = {(a, b) for a in ok for b in ok if a != b and ok[a][1] == ok[b][1] and len(ok[a][0]) == len(ok[b][0])
             and ok[a][0] @ ok[b][0] / (np.linalg.norm(ok[a][0]) * np.linalg.norm(ok[b][0])) >= 0.98}
    comp = {r[0]: r[0] for r in rows}
    for _ in rows:
        for a, b in links:
            comp[a] = comp[b] = min(comp[a], comp[b])
    return {i: (sum(a == i for a, _ in links), comp[i]) for i in comp}


@pytest.mark.parametrize("block", [1024, 16])
def test_recall_and_classes(spark, monkeypatch, block):
    monkeypatch.setattr(pj, "BLOCK", block)
    rng = np.random.default_rng(3)
    rows, n = [], 0
    for label in (0, 1):
        for c in range(25):
            base = rng.standard_normal(64)
            for _ in range(rng.integers(1, 9)):
                v = base + rng.standard_normal(64) * rng.choice([0.0, 0.05, 0.08, 0.1])
                rows.append((n, [float(x) for x in v * rng.choice([1.0, 3.0])], label, "c"))
                n += 1
    rows += [(900, None, 1, "c"), (901, [0.0] * 64, 1, "c"), (902, [float("nan")] + [1.0] * 63, 1, "c"), (903, [None] + [1.0] * 63, 0, "c"),
             (904, rows[0][1], None, "c"), (905, rows[0][1], 0, "c"), (906, [1.0, 2.0], 0, "c"), (907, [2.0, 4.0], 0, "c"), (908, [], 0, "c")]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int, component_id string").repartition(5)
    got = {r.vec_id: (r.n_links, r.component_id) for r in pj.find_links(df).collect()}
    want = brute(rows)
    assert set(got) == set(want)
    found, true = sum(x for x, _ in got.values()), sum(x for x, _ in want.values())
    assert true > 100 and found <= true and found / true >= 0.97
    assert all(got[i][0] <= want[i][0] for i in got)
    assert sum(got[i][1] == want[i][1] for i in got) / len(got) > 0.97


def test_count_rule():
    half, need = pj.collision_rule(0.98)
    assert half == pytest.approx(0.4) and 18 <= need <= 22


def test_empty(spark):
    assert pj.find_links(spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")).count() == 0
