"""What a fitted model does with its features."""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from propensity.operators.models import score
from propensity.operators.ordered import hash_ranks
from propensity.session import keep


def importance(spark: SparkSession, model, names: Sequence[str]) -> DataFrame:
    values = [(n, float(v)) for n, v in zip(names, model.featureImportances.toArray())]
    return spark.createDataFrame(values, "feature string, importance double").orderBy(
        F.desc("importance"), "feature")


def coefficients(spark: SparkSession, model, names: Sequence[str], nonzero: bool = True) -> DataFrame:
    """Intercept and coefficients, largest magnitude first."""
    rows = [("(intercept)", float(model.intercept))]
    rows += [(n, float(v)) for n, v in zip(names, model.coefficients)]
    df = spark.createDataFrame(rows, "feature string, coefficient double")
    if nonzero:
        df = df.filter(F.col("coefficient") != 0)
    return df.orderBy(F.desc(F.abs("coefficient")), "feature")


def regression_summary(spark: SparkSession, model, names: Sequence[str]) -> DataFrame:
    """Coefficients with errors where the fit allows them, and the fit measures as rows."""
    s = model.summary
    if model.getRegParam() == 0 and model.getSolver() == "normal":
        errors = [(float(e), float(p)) for e, p in zip(s.coefficientStandardErrors, s.pValues)]
    else:  # a penalised fit has no standard errors
        errors = [(None, None)] * (len(names) + 1)
    rows = [(n, float(b), *e) for n, b, e in zip(names, model.coefficients.toArray(), errors)]
    rows.append(("(intercept)", float(model.intercept), *errors[-1]))
    rows += [("r2", float(s.r2), None, None), ("rmse", float(s.rootMeanSquaredError), None, None)]
    return spark.createDataFrame(rows, "term string, value double, std_error double, p_value double")


def _with_partner(df: DataFrame, key: str, seed: int) -> DataFrame:
    """Add `__other`: the feature array of the next row in the order of a key hash, the first for the last.

    A permutation of all rows at every size: ranks come from hash ranges, without a global sort.
    """
    ranked = keep(hash_ranks(df, key, seed))
    others = ranked.select((F.col("rank") % F.col("n_group") + 1).alias("__turn"), F.col("__x").alias("__other"))
    return ranked.join(others, F.col("rank") == F.col("__turn")).drop("rank", "n_group", "__turn")


def _replace(array: str, at, value):
    return F.transform(array, lambda x, i: F.when(i == at, value).otherwise(x))


def permutation_importance(model, df: DataFrame, key: str, label: str, names: Sequence[str],
                           seed: int = 42) -> DataFrame:
    """Drop in accuracy when one feature takes the values of other rows."""
    base = df.select(key, label, vector_to_array("features").alias("__x"))
    paired = _with_partner(base, key, seed)
    tests = paired.withColumn("__j", F.explode(F.sequence(F.lit(-1), F.lit(len(names) - 1))))
    changed = F.when(F.col("__j") < 0, F.col("__x")).otherwise(
        F.transform("__x", lambda x, i: F.when(i == F.col("__j"), F.col("__other")[i]).otherwise(x)))
    scored = score(model, tests.select(label, "__j", array_to_vector(changed).alias("features")))
    right = ((F.col("prob") >= 0.5).cast("int") == F.col(label)).cast("double")
    acc = scored.groupBy("__j").agg(F.avg(right).alias("acc"))
    whole = Window.partitionBy()  # one row per feature
    base_acc = F.max(F.when(F.col("__j") < 0, F.col("acc"))).over(whole)
    named = F.array(*[F.lit(n) for n in names])
    return (acc.withColumn("drop", base_acc - F.col("acc")).filter(F.col("__j") >= 0)
            .select(named[F.col("__j")].alias("feature"), F.col("drop").alias("importance")))


def partial_dependence(model, df: DataFrame, grid: dict[int, Sequence[float]]) -> DataFrame:
    """Mean probability over all rows with the given vector slots set to each grid point.

    One or two slots; the grid is a fixed list, so every row is scored once per point.
    """
    out = df.select(vector_to_array("features").alias("__x"))
    keys = []
    for slot, values in grid.items():
        name = f"value_{slot}"
        out = out.withColumn(name, F.explode(F.array(*[F.lit(float(v)) for v in values])))
        out = out.withColumn("__x", _replace("__x", F.lit(slot), F.col(name)))
        keys.append(name)
    scored = score(model, out.select(*keys, array_to_vector("__x").alias("features")))
    return scored.groupBy(*keys).agg(F.avg("prob").alias("mean_prob"))


def orders_of(n: int, count: int, seed: int = 42) -> list[list[int]]:
    """Feature orders in forward and reversed pairs."""
    rng, out = random.Random(seed), []
    while len(out) < count:
        order = list(range(n))
        rng.shuffle(order)
        out += [order, order[::-1]]
    return out[:count]


def shapley_values(model, df: DataFrame, key: str, names: Sequence[str], n_orders: int = 4,
                   seed: int = 42) -> DataFrame:
    """(key, feature, value): mean change of the probability as features move, one after
    another, from the mean row to this row. The values of a row sum to its probability
    minus that of the mean row.
    """
    d = len(names)
    base = df.select(key, vector_to_array("features").alias("__x"))
    mean = base.agg(F.array(*[F.avg(F.col("__x")[i]) for i in range(d)])).scalar()
    orders = orders_of(d, n_orders, seed)
    # position of each feature in the order, so "moved" is position < step
    places = F.array(*[F.array(*[F.lit(o.index(i)) for i in range(d)]) for o in orders])
    turns = F.array(*[F.array(*[F.lit(i) for i in o]) for o in orders])
    steps = (base.withColumn("__mean", mean)
             .withColumn("__o", F.explode(F.sequence(F.lit(0), F.lit(len(orders) - 1))))
             .withColumn("__step", F.explode(F.sequence(F.lit(0), F.lit(d))))
             .withColumn("__places", places[F.col("__o")]))
    mixed = F.transform("__x", lambda x, i: F.when(
        F.col("__places")[i] < F.col("__step"), x).otherwise(F.col("__mean")[i]))
    scored = score(model, steps.select(key, "__o", "__step", array_to_vector(mixed).alias("features")))
    turn = turns[F.col("__o")]
    # the value after step s counts for feature s and against feature s + 1
    shares = F.array(
        F.struct(F.when(F.col("__step") > 0, turn[F.col("__step") - 1]).alias("f"), F.col("prob").alias("v")),
        F.struct(F.when(F.col("__step") < d, F.get(turn, F.col("__step"))).alias("f"), (-F.col("prob")).alias("v")))
    parts = scored.select(key, F.explode(shares).alias("s")).filter(F.col("s.f").isNotNull())
    named = F.array(*[F.lit(n) for n in names])
    return parts.groupBy(key, F.col("s.f").alias("f")).agg(
        (F.sum("s.v") / len(orders)).alias("value")).select(key, named[F.col("f")].alias("feature"), "value")


def mean_absolute(values: DataFrame) -> DataFrame:
    return values.groupBy("feature").agg(F.avg(F.abs("value")).alias("mean_abs")).orderBy(
        F.desc("mean_abs"), "feature")
