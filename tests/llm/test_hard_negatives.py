"""Hard negatives against all pairs; bounds, curve and blocks by themselves."""

import itertools
import math

import numpy as np
import pytest

from propensity.llm import hard_negatives as hn

SCHEMA = "vec_id bigint, embedding array<double>, label int, score string"


def brute(rows):
    ok = {}
    for i, e, label, _ in rows:
        if i is None or label is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        label = int(math.fmod(label + 1, 10)) if i % 7 == 0 else label
        row = (label, [math.floor(256 * x) for x in e])
        ok[i] = row
    out = []
    for a in ok:
        if a % 100:
            continue
        scores = [(sum(x * y for x, y in zip(ok[a][1], e)), i, label) for i, (label, e) in ok.items() if i != a and len(e) == len(ok[a][1])]
        scores.sort(key=lambda s: (-s[0], s[1]))
        for p, pid, _ in [s for s in scores if s[2] == ok[a][0]][:5]:
            fit = [s for s in scores if s[2] != ok[a][0] and 80 * p <= 100 * s[0] <= 100 * p][:5]
            out += [(a, pid, k + 1, n[1], p, n[0]) for k, n in enumerate(fit)]
    return sorted(out)


def vectors(n, dim, seed, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((6, dim)) * 0.2
    rows = []
    for i in range(n):
        x = np.round(centres[i % 6] + rng.standard_normal(dim) * rng.choice([0, 0.02, 0.2]), 2)  # rounded: many equal scores
        rows.append((i * 10 - 200, [float(v) for v in x], int(rng.integers(0, labels)), "clash"))
    return rows


@pytest.mark.parametrize("sizes", [(1024, 256, 1024), (8, 2, 3)])
def test_equals_all_pairs(spark, sizes):
    rows = vectors(400, 12, 3) + vectors(40, 3, 4)[:0]
    rows += [(9000, None, 1, "c"), (9100, [0.1, None] * 6, 1, "c"), (9200, [0.1, float("nan")] * 6, 1, "c"), (9300, [0.1] * 12, None, "c"),
             (None, [0.1] * 12, 1, "c"), (9400, [0.5, 0.5], 1, "c"), (9401, [0.5, 0.5], 1, "c"), (9402, [0.5, 0.45], 2, "c"),
             (9500, [], 1, "c"), (9501, [], 1, "c"), (9502, [], 2, "c"), (9600, [300.0] * 12, 9, "c"), (9601, [299.0] * 12, 9, "c"),
             (9602, [298.0] * 12, 3, "c"), (9700, [0.25] * 12, 77, "c")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    out = hn.hard_negatives(df, *sizes)
    got = sorted(map(tuple, out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()))
    want = brute(rows)
    assert len(want) > 200 and got == want


def test_repeated_ids_count_once(spark):
    rows = vectors(60, 4, 8)
    again = rows + rows[:30] + [(10, [0.0] * 4, 99, "c")]
    one, two = (sorted(map(tuple, hn.hard_negatives(spark.createDataFrame(r, SCHEMA)).collect())) for r in (rows, again))
    assert one and one == two


@pytest.mark.parametrize("rows", [[], [(0, [1.0], 1, "c")], [(0, [1.0], 1, "c"), (1, [1.0], 1, "c")], [(0, None, 1, "c")]])
def test_small_tables(spark, rows):
    assert hn.hard_negatives(spark.createDataFrame(rows, SCHEMA)).count() == 0


@pytest.mark.parametrize("dim, bits", [(2, 4), (3, 2), (5, 1)])
def test_curve_visits_every_cell_by_single_steps(dim, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dim)))
    keys = hn.hilbert_keys(cells, bits)
    assert len(set(keys)) == len(cells)
    path = cells[sorted(range(len(cells)), key=keys.__getitem__)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold_and_are_reached():
    rng = np.random.default_rng(2)
    x, a = rng.integers(-99, 99, (50, 7)), rng.integers(-99, 99, (9, 7))
    least, most = hn.bounds(a, x.min(axis=0)[None], x.max(axis=0)[None])
    scores = a @ x.T
    assert (least[:, 0] <= scores.min(axis=1)).all() and (scores.max(axis=1) <= most[:, 0]).all()
    one = hn.bounds(a, x[:1], x[:1])
    assert (one[0][:, 0] == scores[:, 0]).all() and (one[1][:, 0] == scores[:, 0]).all()


def test_bounds_leave_blocks_out():
    """Two far clusters: the anchor's windows reach one block only."""
    zones = [{"block": b, "dim": 2, "label": 1, "lo": hn.packed(np.array(v)), "hi": hn.packed(np.array(v) + 3)} for b, v in enumerate([(90, 90), (-90, -90)])]
    import pyarrow as pa
    group = {"dim": 2, "label": 2, "n": 1, "ids": np.array([0]).tobytes(), "data": hn.packed(np.array([[100, 100]])),
             "wanted": np.array([[[16000, 20000]]]).tobytes(), "zones": zones}
    out = pa.Table.from_batches(hn._choose(False)(iter([pa.RecordBatch.from_pylist([group])])))
    assert out.column("block").to_pylist() == [0]
