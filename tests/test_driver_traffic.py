"""What fits send to the driver is as large as the models, whatever the bins, rows and partitions."""

import pickle

import numpy as np
import pytest
from pyspark import RDD
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from propensity.operators import boosting as B
from propensity.operators import penalised as P


@pytest.fixture()
def collected(monkeypatch):
    """Bytes of each result that an RDD gives the driver."""
    sizes, collect = [], RDD.collect

    def counted(self):
        got = collect(self)
        sizes.append(len(pickle.dumps(got)))
        return got

    monkeypatch.setattr(RDD, "collect", counted)
    return sizes


def frame(spark, n):
    x = F.array(*[(F.hash("id", F.lit(c)) % m).cast("double") for c, m in ((1, 997), (2, 991), (3, 1), (4, 2))])
    label = (F.pmod(F.hash("id", F.lit(5)), F.lit(3)) + (F.get(x, 0) > 0).cast("int") > 1).cast("int")
    return spark.range(n).select("id", array_to_vector(x).alias("features"), label.alias("label"))


@pytest.mark.parametrize("spec", [B.Spec(rounds=2, depth=2), B.Spec(rounds=4, depth=2, forest=True, columns=2)])
def test_histograms_stay_on_the_executors(spark, collected, spec):
    df, sent = frame(spark, 600), []
    for bins in (4, 200):
        data = B.bin_rows(df, "id", bins=bins)
        collected.clear()
        models = B.fit_spread(data, [B.Job(spec)], part_rows=100)
        sent.append(sum(collected))
        for got, want in zip(models[0].trees, B.fit_local(data, [B.Job(spec)])[0].trees):
            assert all((got[c] == want[c]).all() for c in want)
    assert sent[1] < 1.5 * sent[0] and max(collected) < 4000


def test_moments_reach_the_driver_once(spark, collected):
    data = B.bin_rows(frame(spark, 40_000), "id")
    collected.clear()
    path = P.penalty_paths(data, folds=2, n_penalties=20, steps=3)[0]
    counts = 3 * 20 * 2 * P.SCORE_BINS * 8  # fits, penalties, labels, score bins
    assert max(collected) < 1.2 * counts
    assert path.auc.max() > 0.6 and (path.coefficients[0] == 0).all() and np.abs(path.coefficients[-1][0]) > 0
