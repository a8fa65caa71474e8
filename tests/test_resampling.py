import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from propensity.operators import balance as B
from propensity.operators import neighbours as N
from propensity.operators.neighbours import distinct_points, nearest


def brute(points, i, k):
    d = np.sqrt(((points - points[i]) ** 2).sum(axis=1))
    d[i] = np.inf
    return np.sort(d)[:k]


@pytest.mark.parametrize("pivots", [1, 7, 40])
def test_nearest_is_exact(spark, pivots):
    rng = np.random.default_rng(0)
    x = np.vstack([rng.normal(size=(150, 3)), rng.normal(size=(60, 3)) * 0.01 + 5])
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(1000 + i, x[0].tolist()) for i in range(100)]  # a third of the rows are one point
    df = spark.createDataFrame(rows, "id bigint, v array<double>")
    points = distinct_points(df, "id", "v")
    got = {r.pid: [n.distance for n in r.neighbours] for r in nearest(points, 4, pivots).collect()}
    assert sorted(got) == list(range(len(x)))
    for i in got:
        assert got[i] == pytest.approx(brute(x, i, 4).tolist(), abs=1e-12)
    assert {r.pid: r.copies for r in points.collect()}[0] == 101


def test_nearest_deals_cells_to_many_tasks(spark, monkeypatch):
    """Cells are dealt by the number of points: they are few bytes and would meet in one task."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 2)).round(1)  # equal distances
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, v array<double>")
    points = distinct_points(df, "id", "v")
    monkeypatch.setattr(N, "TASK", 50)
    monkeypatch.setattr(N, "CELLS", 1000)
    found = nearest(points, 4).withColumn("task", F.spark_partition_id()).collect()
    assert len({r.task for r in found}) > 5
    at = {r.pid: r.v for r in points.collect()}
    ids = np.array(sorted(at))
    y = np.array([at[i] for i in ids])
    for r in found:
        d = np.sqrt(((y - np.array(at[r.pid])) ** 2).sum(axis=1))
        d[ids == r.pid] = np.inf
        assert [n.pid for n in r.neighbours] == ids[np.lexsort((ids, d))[:4]].tolist()
        assert all(n.v == at[n.pid] and n.copies >= 1 for n in r.neighbours)


def test_nearest_with_too_few_points(spark):
    df = spark.createDataFrame([(1, [0.0]), (2, [1.0])], "id bigint, v array<double>")
    got = {r.pid: len(r.neighbours) for r in nearest(distinct_points(df, "id", "v"), 5).collect()}
    assert got == {1: 1, 2: 1}
    one = nearest(distinct_points(df.filter("id = 1"), "id", "v"), 5).collect()
    assert [len(r.neighbours) for r in one] == [0]


def rows(spark, n=300):
    rng = random.Random(2)
    data = [(i, int(i % 6 == 0), rng.random(), rng.gauss(0, 5)) for i in range(n)]
    return spark.createDataFrame(data, "id bigint, y int, a double, b double")


def test_weights(spark):
    df = B.add_class_weight(rows(spark), "y")
    sums = {r.y: r.s for r in df.groupBy("y").agg(F.sum("class_weight").alias("s")).collect()}
    assert sums[0] == pytest.approx(150) and sums[1] == pytest.approx(150)
    w = B.add_positive_weight(rows(spark), "y").filter("y = 1").first().pos_weight
    assert w == pytest.approx(5.0)


def test_over_and_undersample(spark):
    over = B.oversample(rows(spark), "id", "y")
    assert {r.y: r["count"] for r in over.groupBy("y").count().collect()} == {0: 250, 1: 250}
    assert over.select("id", "copy").distinct().count() == 500
    under = B.undersample(rows(spark), "id", "y")
    assert {r.y: r["count"] for r in under.groupBy("y").count().collect()} == {0: 50, 1: 50}


def test_smoothed_bootstrap(spark):
    out = B.smoothed_bootstrap(rows(spark, 2000), "id", "y", ["a", "b"])
    n = {r.y: r["count"] for r in out.groupBy("y").count().collect()}
    assert sum(n.values()) == 2000 and abs(n[1] - 1000) < 120
    assert abs(out.agg(F.stddev("b")).first()[0] - 5) < 1


def test_minority_interpolation(spark):
    df = rows(spark)
    out = B.interpolate_minority(df, "id", "y", ["a", "b"], k=5)
    n = {r.origin: r["count"] for r in out.groupBy("origin").count().collect()}
    assert n == {"minority": 50, "synthetic": 100, "majority": 150}
    # a synthetic row lies on the segment between its row and one of the five nearest rows
    minority = {r.id: np.array([r.a, r.b]) for r in df.filter("y = 1").collect()}
    x = np.array(list(minority.values()))
    span = x.max(axis=0) - x.min(axis=0)
    for r in out.filter("origin = 'synthetic'").collect():
        at, start = np.array([r.a, r.b]) / span, minority[r.id] / span
        near = sorted(minority, key=lambda i: ((minority[i] / span - start) ** 2).sum())[1:6]
        gaps = []
        for i in near:
            way = minority[i] / span - start
            t = np.clip((at - start) @ way / (way @ way), 0, 1)
            gaps.append(np.abs(start + t * way - at).max())
        assert min(gaps) < 1e-9


def test_interpolation_with_copies(spark):
    """A third of the minority is one point; its neighbours are its own copies."""
    data = [(i, 1, 1.0, 1.0) for i in range(10)] + [(i, 1, float(i), 2.0) for i in range(10, 30)]
    data += [(i, 0, 0.0, 0.0) for i in range(30, 100)]
    df = spark.createDataFrame(data, "id bigint, y int, a double, b double")
    out = B.interpolate_minority(df, "id", "y", ["a", "b"], k=5).filter("origin = 'synthetic' AND id < 10")
    assert out.count() == 20
    assert {(round(r.a, 9), round(r.b, 9)) for r in out.collect()} == {(1.0, 1.0)}
