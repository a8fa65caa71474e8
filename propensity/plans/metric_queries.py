"""Evaluation (E) over the written scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from propensity.functions import columns as C
from propensity.functions import fixed_values as V
from propensity.operators import aggregates as A
from propensity.operators import metrics as M
from propensity.plans import view_sql as Q
from propensity.plans.order_queries import sweep_sql
from propensity.plans.registry import query, rnd
from propensity.sources import views

CELLS = """cells AS (SELECT count(*) FILTER (label = 1 AND p_rf >= 0.4) AS tp,
 count(*) FILTER (label = 0 AND p_rf >= 0.4) AS fp, count(*) FILTER (label = 0 AND p_rf < 0.4) AS tn,
 count(*) FILTER (label = 1 AND p_rf < 0.4) AS fn FROM scores)"""


def _cells(spark, d):
    return M.confusion(views.scores(spark, d), "label", F.col("p_rf") >= 0.4)


def rounded(df, cols, digits=6):
    return df.select(*[C.half_up(F.col(c), digits).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


@query("e1_confusion_cells", Q.with_views(Q.SCORES, CELLS) + "SELECT * FROM cells")
def e1(spark, d):
    return _cells(spark, d)


_D = "CAST({} AS DOUBLE)"


@query("e2_accuracy_precision_recall_f1", Q.with_views(Q.SCORES, CELLS) + f"""
SELECT {rnd('CAST(tp + tn AS DOUBLE) / (tp + fp + tn + fn)', 6)} AS accuracy,
{rnd('CAST(tp AS DOUBLE) / (tp + fp)', 6)} AS precision, {rnd('CAST(tp AS DOUBLE) / (tp + fn)', 6)} AS recall,
{rnd('2.0 * tp / (2 * tp + fp + fn)', 6)} AS f1,
{rnd('(2.0 * tp / (2 * tp + fp + fn) * (tp + fn) + 2.0 * tn / (2 * tn + fp + fn) * (tn + fp)) / (tp + fp + tn + fn)', 6)} AS f1_weighted
FROM cells""")
def e2(spark, d):
    names = ["accuracy", "precision", "recall", "f1", "f1_weighted"]
    return rounded(M.rates(_cells(spark, d), names).select(*names), names)


@query("e3_sensitivity_specificity_kappa", Q.with_views(Q.SCORES, CELLS) + f"""
SELECT {rnd('CAST(tp AS DOUBLE) / (tp + fn)', 6)} AS sensitivity, {rnd('CAST(tn AS DOUBLE) / (tn + fp)', 6)} AS specificity,
{rnd('CAST(tp AS DOUBLE) / (tp + fp)', 6)} AS ppv, {rnd('(po - pe) / (1 - pe)', 6)} AS kappa FROM (
SELECT *, CAST(tp + tn AS DOUBLE) / (tp + fp + tn + fn) AS po,
 (CAST((tp + fp) * (tp + fn) AS DOUBLE) + (tn + fn) * (tn + fp)) / ((tp + fp + tn + fn) * (tp + fp + tn + fn)) AS pe FROM cells)""")
def e3(spark, d):
    out = M.rates(_cells(spark, d), ["recall", "specificity", "precision", "kappa"]).select(
        F.col("recall").alias("sensitivity"), "specificity", F.col("precision").alias("ppv"), "kappa")
    return rounded(out, out.columns)


AUC_BY_MODEL = """ranked AS (SELECT *, rank() OVER (PARTITION BY model ORDER BY p)
 + (count(*) OVER (PARTITION BY model, p) - 1) / 2.0::DOUBLE AS r FROM long_scores),
aucs AS (SELECT model, (sum(r) FILTER (label = 1) - sum(label) * (sum(label) + 1) / 2.0::DOUBLE)
 / (CAST(sum(label) AS DOUBLE) * (count(*) - sum(label))) AS auc FROM ranked GROUP BY model)"""


@query("e4_auc_roc", Q.with_views(Q.LONG_SCORES, AUC_BY_MODEL) + f"SELECT model, {rnd('auc', 6)} AS auc FROM aucs")
def e4(spark, d):
    return rounded(M.auc_roc(views.long_scores(spark, d), "label", "p", ["model"]), ["auc"])


CURVE = """pts AS (SELECT p_rf AS score, sum(sum(label)) OVER w AS tp, sum(sum(1 - label)) OVER w AS fp,
 sum(label) AS pos, sum(sum(label)) OVER () AS all_pos, sum(sum(1 - label)) OVER () AS all_neg
 FROM scores GROUP BY p_rf WINDOW w AS (ORDER BY p_rf DESC))"""


@query("e5_auc_pr", Q.with_views(Q.SCORES, CURVE) + f"""
SELECT {rnd('sum(pos / all_pos * (tp / (tp + fp)))', 6)} AS auc_pr FROM pts""")
def e5(spark, d):
    return rounded(M.auc_pr(views.scores(spark, d), "label", "p_rf"), ["auc_pr"])


@query("e6_curve_points", Q.with_views(Q.SCORES, CURVE) + f"""
SELECT score, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, {rnd('tp / all_pos', 6)} AS tpr,
{rnd('fp / all_neg', 6)} AS fpr, {rnd('tp / (tp + fp)', 6)} AS precision FROM pts""")
def e6(spark, d):
    pts = M.curve_points(views.scores(spark, d), "label", "p_rf").drop("gain")
    return rounded(pts, ["tpr", "fpr", "precision"])


@query("e7_threshold_sweep", Q.with_views(Q.SCORES, sweep_sql("p_gbm", *V.SWEEP_FINE)) + f"""
SELECT pct, tp, fp, tn, fn, {rnd('f1', 6)} AS f1, pct = (SELECT pct FROM rated WHERE f1 IS NOT NULL
 ORDER BY f1 DESC, pct LIMIT 1) AS is_best FROM rated""")
def e7(spark, d):
    sweep = M.threshold_sweep(views.scores(spark, d), "label", "p_gbm", M.grid(*V.SWEEP_FINE))
    out = M.mark_best(sweep).drop("precision", "recall")
    return rounded(out, ["f1"])


def loan_estimates(spark, d):
    """A written price formula next to the true price, for the error measures."""
    estimate = F.col("l_quantity") * 2000 * (1 - F.col("l_discount")) + 1000
    return views.loans(spark, d).withColumn("predicted", estimate)


EST = """est AS (SELECT *, l_extendedprice AS loan_amount, l_quantity * 2000 * (1 - l_discount) + 1000 AS predicted
FROM lineitem)"""


@query("e8_regression_errors", f"""WITH {EST} SELECT {rnd('avg(abs(loan_amount - predicted))', 4)} AS mae,
{rnd('avg(pow(loan_amount - predicted, 2))', 1)} AS mse, {rnd('sqrt(avg(pow(loan_amount - predicted, 2)))', 4)} AS rmse FROM est""")
def e8(spark, d):
    out = M.regression_errors(loan_estimates(spark, d), "loan_amount", "predicted")
    return out.select(C.half_up(F.col("mae"), 4).alias("mae"), C.half_up(F.col("mse"), 1).alias("mse"),
                      C.half_up(F.col("rmse"), 4).alias("rmse"))


@query("e9_percent_accuracy", f"""WITH {EST} SELECT {rnd('avg(100 * abs(loan_amount - predicted) / loan_amount)', 4)} AS mape,
{rnd('100 - avg(100 * abs(loan_amount - predicted) / loan_amount)', 4)} AS accuracy,
count(*) FILTER (loan_amount = 0) AS zero_targets FROM est""")
def e9(spark, d):
    return rounded(M.percent_accuracy(loan_estimates(spark, d), "loan_amount", "predicted"),
                   ["mape", "accuracy"], 4)


@query("e10_squared_correlation", f"""WITH {EST} SELECT {rnd('pow(corr(loan_amount, predicted), 2)', 6)} AS r2 FROM est""")
def e10(spark, d):
    out = M.regression_errors(loan_estimates(spark, d), "loan_amount", "predicted")
    return out.select(C.half_up(F.col("r2"), 6).alias("r2"))


@query("e13_calibration", Q.with_views(Q.SCORES) + f"""
SELECT CAST(greatest(ceil(p_rf * 10), 1) AS INTEGER) AS bin, count(*) AS n, {rnd('avg(p_rf)', 6)} AS mean_p,
{rnd('avg(label)', 6)} AS mean_y FROM scores GROUP BY 1""")
def e13(spark, d):
    return rounded(A.bin_means(views.scores(spark, d), "p_rf", "label"), ["mean_p", "mean_y"])


@query("e14_actual_predicted", f"""WITH {EST} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
loan_amount AS actual, {rnd('predicted', 4)} AS predict FROM est""")
def e14(spark, d):
    return loan_estimates(spark, d).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("loan_amount").alias("actual"),
        C.half_up(F.col("predicted"), 4).alias("predict"))


@query("e15_class_errors", Q.with_views(Q.SCORES) + f"""
SELECT label, count(*) AS n, {rnd('avg(CAST(label <> CAST(p_rf >= 0.4 AS INTEGER) AS INTEGER))', 6)} AS error
FROM scores GROUP BY ROLLUP (label)""")
def e15(spark, d):
    return rounded(M.class_errors(views.scores(spark, d), "label", F.col("p_rf") >= 0.4), ["error"])
