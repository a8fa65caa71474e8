import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from propensity.operators import ensemble as N
from propensity.operators import metrics as M


def frame(spark, rows):
    return spark.createDataFrame(rows, "label int, p double")


def brute_auc(rows):
    pos = [p for y, p in rows if y == 1]
    neg = [p for y, p in rows if y == 0]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


@pytest.fixture(scope="module")
def tied():
    rng = random.Random(5)
    return [(int(rng.random() < 0.3), 0.5 if i % 3 == 0 else round(rng.random(), 2)) for i in range(600)]


def test_auc_with_ties(spark, tied):
    got = M.auc_roc(frame(spark, tied), "label", "p").first().auc
    assert got == pytest.approx(brute_auc(tied), abs=1e-12)
    ev = BinaryClassificationEvaluator(rawPredictionCol="p", labelCol="label", numBins=0)
    assert got == pytest.approx(ev.evaluate(frame(spark, tied)), abs=1e-9)


def test_auc_of_one_class_is_null(spark):
    assert M.auc_roc(frame(spark, [(1, 0.2), (1, 0.9)]), "label", "p").first().auc is None


def test_auc_pr_step_sum(spark, tied):
    got = M.auc_pr(frame(spark, tied), "label", "p").first().auc_pr
    total = sum(y for y, _ in tied)
    want, before = 0.0, 0
    for s in sorted({p for _, p in tied}, reverse=True):
        tp = sum(y for y, p in tied if p >= s)
        want += (tp - before) / total * tp / sum(p >= s for _, p in tied)
        before = tp
    assert got == pytest.approx(want, abs=1e-12)


def test_rates_without_predictions(spark):
    cells = M.confusion(frame(spark, [(1, 0.1), (0, 0.2)]), "label", F.col("p") >= 0.9)
    r = M.rates(cells, ["precision", "recall", "f1", "kappa"]).first()
    assert (r.precision, r.recall, r.f1) == (None, 0.0, 0.0)


def test_sweep_matches_loop(spark, tied):
    sweep = {r.pct: r for r in M.threshold_sweep(frame(spark, tied), "label", "p", M.grid(10, 90, 5)).collect()}
    assert len(sweep) == 17
    for t, r in sweep.items():
        tp = sum(y == 1 and p >= t / 100 for y, p in tied)
        fp = sum(y == 0 and p >= t / 100 for y, p in tied)
        assert (r.tp, r.fp, r.tp + r.fn, r.fp + r.tn) == (
            tp, fp, sum(y for y, _ in tied), sum(1 - y for y, _ in tied))


def test_best_threshold_takes_lowest_tie(spark):
    sweep = M.threshold_sweep(frame(spark, [(1, 0.95), (0, 0.05)]), "label", "p", M.grid(10, 90, 10))
    assert M.best_threshold(sweep).first().pct == 10
    assert [r.pct for r in M.mark_best(sweep).filter("is_best").collect()] == [10]


def test_zero_targets_are_counted(spark):
    df = spark.createDataFrame([(0.0, 1.0), (10.0, 9.0)], "y double, p double")
    r = M.percent_accuracy(df, "y", "p").first()
    assert (r.zero_targets, r.mape, r.accuracy) == (1, 10.0, 90.0)


def test_class_errors(spark):
    got = {r.label: r.error for r in M.class_errors(
        frame(spark, [(1, 0.9), (1, 0.1), (0, 0.2), (0, 0.3)]), "label", F.col("p") >= 0.5).collect()}
    assert got == {1: 0.5, 0: 0.0, None: 0.25}


def test_votes(spark):
    df = spark.createDataFrame([(0.6, 0.6, 0.1), (0.6, 0.1, 0.1)], "a double, b double, c double")
    got = df.select(N.hard_vote(["a", "b", "c"]).alias("h"), N.soft_vote(["a", "b", "c"]).alias("s")).collect()
    assert [r.h for r in got] == [1, 0]
    assert got[0].s == pytest.approx(1.3 / 3)


def test_weight_search_finds_the_informative_score(spark):
    rng = random.Random(3)
    rows = [(y, round(0.5 * y + 0.4 * rng.random(), 4), round(rng.random(), 4)) for y in [0, 1] * 150]
    df = spark.createDataFrame(rows, "label int, good double, noise double")
    every = N.search_weights(df, "label", ["good", "noise"])
    assert every.count() == len(N.simplex(2, 4)) == 5
    best = N.best_weights(every).first()
    assert best.w_good == 4
    assert best.auc == pytest.approx(brute_auc([(y, g) for y, g, _ in rows]), abs=1e-12)
