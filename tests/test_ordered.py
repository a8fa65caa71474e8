import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from propensity.operators import ordered as O
from propensity.operators import sampling as S


def hot_rows():
    """A third of the rows share one value and most rows are in one group."""
    rng = random.Random(1)
    rows = [("a", 5.0)] * 200 + [("a", round(rng.gauss(0, 3), 2)) for _ in range(350)]
    rows += [("b", round(rng.random(), 1)) for _ in range(50)]
    return rows


def test_exact_quantiles_match_numpy(spark):
    rows = hot_rows() + [("a", None), ("b", float("nan"))]
    df = spark.createDataFrame(rows, "g string, x double").repartition(5)
    got = {r.g: r for r in O.exact_quantiles(df, "x", {"q05": 0.05, "med": 0.5, "q95": 0.95}, ["g"]).collect()}
    for g in "ab":
        x = [v for k, v in hot_rows() if k == g]
        for name, p in (("q05", 0.05), ("med", 0.5), ("q95", 0.95)):
            assert got[g][name] == pytest.approx(np.quantile(x, p), abs=1e-12)


def test_quantiles_of_few_rows(spark):
    df = spark.createDataFrame([(3.0,)], "x double")
    assert O.exact_quantiles(df, "x", {"m": 0.5}).first().m == 3.0
    none = O.exact_quantiles(df.filter("x > 9"), "x", {"m": 0.5}).collect()
    assert none == [] or none[0].m is None


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals(spark, descending):
    counts = spark.createDataFrame(hot_rows(), "g string, x double").groupBy("g", "x").agg(
        F.count("*").alias("n"))
    got = O.running_totals(counts, "x", ["n"], ["g"], descending).collect()
    for r in got:
        x = [v for k, v in hot_rows() if k == r.g]
        want = sum(v >= r.x for v in x) if descending else sum(v <= r.x for v in x)
        assert (r.cum_n, r.all_n) == (want, len(x))


def test_hash_ranks_are_a_permutation(spark):
    df = spark.range(1000).withColumn("g", F.when(F.col("id") < 900, "big").otherwise("small"))
    got = O.hash_ranks(df, "id", 3, ["g"]).collect()
    for g, n in (("big", 900), ("small", 100)):
        assert sorted(r["rank"] for r in got if r.g == g) == list(range(1, n + 1))
        assert {r.n_group for r in got if r.g == g} == {n}


@pytest.mark.parametrize("digits", [1, 3])
def test_first_by_hash_agrees_with_ranks(spark, digits):
    df = spark.range(500).withColumn("g", F.col("id") % 3)
    want = {r.id for r in O.hash_ranks(df, "id", 7, ["g"]).filter("rank <= 40").collect()}
    marked = O.first_by_hash(df, "id", F.lit(40), 7, ["g"], hex_digits=digits)
    assert marked.count() == 500
    assert {r.id for r in marked.filter("chosen").collect()} == want


def test_split_and_fold_sizes(spark):
    df = spark.range(1003).withColumn("label", (F.col("id") % 10 == 0).cast("int"))
    split = S.stratified_split(df, "id", "label", 0.8).groupBy("label").agg(
        F.count_if("is_train").alias("t"), F.count("*").alias("n")).collect()
    assert all(r.t == int(np.ceil(0.8 * r.n)) for r in split)
    folds = S.stratified_folds(df, "id", "label", 5).groupBy("label", "fold").count().collect()
    for y in (0, 1):
        sizes = [r["count"] for r in folds if r.label == y]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_fixed_sample_size(spark):
    df = spark.range(300)
    assert S.fixed_sample(df, "id", 50).count() == 50
    assert S.fixed_sample(df, "id", 5000).count() == 300


def test_random_split_covers_all_rows(spark):
    parts = S.random_split(spark.range(2000), "id", [0.7, 0.15, 0.15])
    ids = [r.id for p in parts for r in p.collect()]
    assert sorted(ids) == list(range(2000))
    assert abs(parts[0].count() - 1400) < 100


def test_keep_first_and_top_n(spark):
    df = spark.createDataFrame([("u", 2, "x"), ("u", 1, "y"), ("v", 5, None)], "k string, o int, s string")
    assert sorted(map(tuple, O.keep_first(df, ["k"], ["o"]).collect())) == [("u", 1, "y"), ("v", 5, None)]
    assert O.top_n(df, ["k"], [F.desc("o")], 1).count() == 2


def test_arg_best_takes_first_tie(spark):
    df = spark.createDataFrame([(1, 0.5), (2, 0.9), (3, 0.9), (4, None)], "i int, m double")
    assert O.arg_best(df, "m", "i").first().i == 2
    assert O.arg_best(df, "m", "i", largest=False).first().i == 1
    both = {r.side: r.i for r in O.arg_extremes(df, "m", "i").collect()}
    assert both == {"max": 2, "min": 1}
