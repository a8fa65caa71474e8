"""Exact evaluation of scored rows.

Every function takes optional `by` columns, so several models or folds are evaluated
in one job. Ranking metrics first count rows per distinct score (combined on the map
side) and then use range-wise running totals; no task sees all scores.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propensity.operators.ordered import arg_best, running_totals
from propensity.session import keep


def confusion(df: DataFrame, label: str, predicted: Column, by: Sequence[str] = ()) -> DataFrame:
    pos, hit = F.col(label) == 1, predicted
    return df.groupBy(*by).agg(
        F.count_if(pos & hit).alias("tp"), F.count_if(~pos & hit).alias("fp"),
        F.count_if(~pos & ~hit).alias("tn"), F.count_if(pos & ~hit).alias("fn"))


def rates(cells: DataFrame, names: Sequence[str]) -> DataFrame:
    """Add the named rates to confusion cells; a rate without cases is null."""
    tp, fp, tn, fn = (F.col(c).cast("double") for c in ("tp", "fp", "tn", "fn"))
    n = tp + fp + tn + fn
    chance = ((tp + fp) * (tp + fn) + (tn + fn) * (tn + fp)) / (n * n)
    agree = (tp + tn) / n
    known = {
        "accuracy": F.try_divide(tp + tn, n),
        "precision": F.try_divide(tp, tp + fp),
        "recall": F.try_divide(tp, tp + fn),
        "f1": F.try_divide(2 * tp, 2 * tp + fp + fn),
        "specificity": F.try_divide(tn, tn + fp),
        "balanced_accuracy": (F.try_divide(tp, tp + fn) + F.try_divide(tn, tn + fp)) / 2,
        "kappa": F.try_divide(agree - chance, 1 - chance),
        "f1_weighted": (F.try_divide(2 * tp, 2 * tp + fp + fn) * (tp + fn)
                        + F.try_divide(2 * tn, 2 * tn + fp + fn) * (tn + fp)) / n,
    }
    return cells.select("*", *[known[m].alias(m) for m in names])


def _counts(df: DataFrame, label: str, score: str, by: Sequence[str]) -> DataFrame:
    return (df.groupBy(*by, F.col(score).alias("score"))
            .agg(F.count_if(F.col(label) == 1).alias("pos"),
                 F.count_if(F.col(label) == 0).alias("neg")))


def _auc(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    run = running_totals(counts, "score", ["pos", "neg"], by)
    wins = F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") / 2))
    pairs = (F.max("all_pos") * F.max("all_neg")).cast("double")
    return run.groupBy(*by).agg(F.try_divide(wins, pairs).alias("auc"))


def auc_roc(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve; equal scores count one half."""
    return _auc(_counts(df, label, score, by), by)


def curve_points(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """ROC and precision-recall points, one per distinct score, highest score first."""
    run = running_totals(_counts(df, label, score, by), "score", ["pos", "neg"], by,
                         descending=True)
    tp, fp = F.col("cum_pos"), F.col("cum_neg")
    return run.select(*by, "score", tp.alias("tp"), fp.alias("fp"),
                      F.try_divide(tp.cast("double"), F.col("all_pos")).alias("tpr"),
                      F.try_divide(fp.cast("double"), F.col("all_neg")).alias("fpr"),
                      (tp / (tp + fp)).alias("precision"),
                      F.try_divide(F.col("pos").cast("double"), F.col("all_pos")).alias("gain"))


def auc_pr(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Area under precision-recall as the step sum over distinct scores."""
    pts = curve_points(df, label, score, by)
    return pts.groupBy(*by).agg(F.sum(F.col("gain") * F.col("precision")).alias("auc_pr"))


def grid(first: int, last: int, step: int) -> list[int]:
    return list(range(first, last + 1, step))


def threshold_sweep(df: DataFrame, label: str, score: str, percents: Sequence[int],
                    by: Sequence[str] = ()) -> DataFrame:
    """Confusion cells and F1 per threshold in one pass over the rows."""
    cells = ", ".join(
        f"count_if({label} = 1 AND {score} >= {t / 100.0}D) AS tp{i}, "
        f"count_if({label} <> 1 AND {score} >= {t / 100.0}D) AS fp{i}" for i, t in enumerate(percents))
    one = df.groupBy(*by).agg(
        F.expr(f"count_if({label} = 1)").alias("p"), F.expr(f"count_if({label} <> 1)").alias("n"),
        F.expr(f"struct({cells})").alias("cells"))
    rows = ", ".join(f"struct({t} AS pct, cells.tp{i} AS tp, cells.fp{i} AS fp, n - cells.fp{i} AS tn, "
                     f"p - cells.tp{i} AS fn)" for i, t in enumerate(percents))
    return rates(one.select(*by, F.expr(f"inline(array({rows}))")), ["precision", "recall", "f1"])


def best_threshold(sweep: DataFrame, metric: str = "f1") -> DataFrame:
    """The sweep row with the best metric; the lowest threshold wins a tie."""
    return arg_best(sweep, metric, "pct")


def mark_best(sweep: DataFrame, metric: str = "f1") -> DataFrame:
    """Add is_best to a sweep. The window covers the thresholds only, not the scored rows."""
    order = Window.partitionBy().orderBy(F.desc_nulls_last(metric), "pct")
    return sweep.withColumn("is_best", F.row_number().over(order) == 1)


def regression_errors(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    a, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    e = a - p
    return df.groupBy(*by).agg(
        F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"),
        F.sqrt(F.avg(e * e)).alias("rmse"), F.pow(F.corr(a, p), 2).alias("r2"))


def percent_accuracy(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """100 minus the mean absolute percent error; rows with a zero target are counted apart."""
    a, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    pct = F.try_divide(100 * F.abs(a - p), a)
    return df.groupBy(*by).agg(F.avg(pct).alias("mape"), (100 - F.avg(pct)).alias("accuracy"),
                               F.count_if(a == 0).alias("zero_targets"))


def class_errors(df: DataFrame, label: str, predicted: Column) -> DataFrame:
    """Error rate per class and, with a null class, over all rows."""
    wrong = (F.col(label) != predicted.cast("int")).cast("double")
    return (df.select(F.col(label), wrong.alias("wrong")).rollup(label)
            .agg(F.count("*").alias("n"), F.avg("wrong").alias("error")))


def score_table(df: DataFrame, label: str, score: str, threshold: float,
                by: Sequence[str]) -> DataFrame:
    """AUC, F1 and accuracy side by side for each group (usually the model).

    Both come from one table of counts per distinct score.
    """
    counts = keep(_counts(df, label, score, by))
    hit = F.col("score") >= threshold
    part = lambda c, cond: F.sum(F.when(cond, F.col(c)).otherwise(0))
    cells = counts.groupBy(*by).agg(part("pos", hit).alias("tp"), part("neg", hit).alias("fp"),
                                    part("neg", ~hit).alias("tn"), part("pos", ~hit).alias("fn"))
    return _auc(counts, by).join(rates(cells, ["f1", "accuracy"]).select(*by, "f1", "accuracy"), list(by))
