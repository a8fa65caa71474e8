"""Ensembles (N)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from propensity.functions import columns as C
from propensity.operators import aggregates as A
from propensity.operators import ensemble as N
from propensity.operators import metrics as E
from propensity.operators.models import BASE_MODELS
from propensity.plans import view_sql as Q
from propensity.plans.metric_queries import AUC_BY_MODEL, rounded
from propensity.plans.order_queries import u_sql
from propensity.plans.prepared import churn_data
from propensity.plans.registry import query, rnd
from propensity.session import keep
from propensity.sources import views

COLS = [f"p_{m}" for m in views.MODELS]

BASE: dict[str, dict] = {name: {} for name in BASE_MODELS}
FINAL: dict[str, dict] = {"forest": {"rounds": 500}}  # of the fits on all training rows


@query("n1_hard_vote", Q.with_views(Q.SCORES) + "SELECT custkey, CAST(" + " + ".join(
    f"CAST({c} >= 0.5 AS INTEGER)" for c in COLS) + " >= 3 AS INTEGER) AS prediction FROM scores")
def n1(spark, d):
    return views.scores(spark, d).select("custkey", N.hard_vote(COLS).alias("prediction"))


@query("n2_soft_vote", Q.with_views(Q.SCORES) + f"SELECT custkey, {rnd('(' + ' + '.join(COLS) + ') / 5', 6)} AS prob FROM scores")
def n2(spark, d):
    return views.scores(spark, d).select("custkey", C.half_up(N.soft_vote(COLS), 6).alias("prob"))


@query("n3_auc_weighted_average", Q.with_views(Q.LONG_SCORES, AUC_BY_MODEL, """w AS (SELECT model,
auc / sum(auc) OVER () AS w FROM aucs)""") + f"""
SELECT custkey, {rnd('sum(p * w)', 6)} AS prob FROM long_scores JOIN w USING (model) GROUP BY 1""")
def n3(spark, d):
    kept = keep(views.scores(spark, d).select("custkey", "label", *COLS))
    rows = kept.withColumn("w", N.auc_weights(kept, "label", COLS))
    return rows.select("custkey", C.half_up(N.weighted(COLS, F.col("w")), 6).alias("prob"))


_GRID = " , ".join(f"range(0, 5) r{i}(w{i})" for i in range(4))


@query("n4_weight_search", Q.with_views(Q.SCORES, f"""grid AS (SELECT *, 4 - w0 - w1 - w2 - w3 AS w4 FROM {_GRID}
WHERE w0 + w1 + w2 + w3 <= 4), mixed AS (SELECT w0, w1, w2, w3, w4, label,
""" + " + ".join(f"w{i} * CAST(round({c} * 10000) AS BIGINT)" for i, c in enumerate(COLS)) + """ AS mix FROM scores, grid),
rk AS (SELECT *, rank() OVER (PARTITION BY w0, w1, w2, w3 ORDER BY mix) + (count(*) OVER (PARTITION BY w0, w1, w2, w3, mix) - 1) / 2.0::DOUBLE AS r FROM mixed)""")
       + f"""SELECT CAST(w0 AS INTEGER) AS w_p_rf, CAST(w1 AS INTEGER) AS w_p_gbm, CAST(w2 AS INTEGER) AS w_p_xgb,
CAST(w3 AS INTEGER) AS w_p_lgb, CAST(w4 AS INTEGER) AS w_p_lasso,
{rnd('(sum(r) FILTER (label = 1) - sum(label) * (sum(label) + 1) / 2.0::DOUBLE) / (CAST(sum(label) AS DOUBLE) * (count(*) - sum(label)))', 6)} AS auc
FROM rk GROUP BY w0, w1, w2, w3, w4""")
def n4(spark, d):
    out = N.search_weights(views.scores(spark, d), "label", COLS)
    return rounded(out.drop("candidate"), ["auc"])


@query("n4_refined_weights")
def n4_refined(spark, d):
    return N.refine_weights(views.scores(spark, d), "label", COLS)


@query("n5_out_of_fold_scores")
def n5(spark, d):
    data = churn_data(spark, d)
    out = N.out_of_fold(data.train, "CustomerID", BASE, 5)
    return out.select("CustomerID", "label", "fold", *[f"prob_{n}" for n in BASE])


@query("n5_out_of_fold_keys", Q.with_views(Q.CHURN, f"""train AS (SELECT * FROM churn WHERE {u_sql('"CustomerID"')} < 0.7)""") + """
SELECT "CustomerID", "Churn" AS label, CAST((row_number() OVER (PARTITION BY "Churn"
ORDER BY md5(CAST("CustomerID" AS VARCHAR) || '|42'), "CustomerID") - 1) % 5 AS INTEGER) AS fold, TRUE AS in_range FROM train""")
def n5_keys(spark, d):
    """Each training row once, in its fold, with scores between 0 and 1."""
    out = N.out_of_fold(churn_data(spark, d).train, "CustomerID", BASE, 5)
    inside = reduce(lambda a, b: a & b, [F.col(f"prob_{n}").between(0, 1) for n in BASE])
    return out.select("CustomerID", "label", "fold", inside.alias("in_range"))


@query("n6_stacking")
def n6(spark, d):
    data = churn_data(spark, d)
    stack = N.fit_stack(data.train, "CustomerID", BASE, 5, final=FINAL)
    return stack.score(data.test).select("CustomerID", "label", *stack.columns, "prob_stack")


@query("n7_blending")
def n7(spark, d):
    data = churn_data(spark, d)
    blend = N.fit_blend(data.train, data.val, "CustomerID", BASE)
    return blend.score(data.test, "prob_blend").select("CustomerID", "label", *blend.columns, "prob_blend")


@query("n8_model_list_stack")
def n8(spark, d):
    data = churn_data(spark, d)
    specs = {"forest": {}, "boosted": {}, "tree": {}, "bayes": {}, "lasso": {}}
    stack = N.fit_stack(data.train, "CustomerID", specs, 5)
    return stack.score(data.test).select("CustomerID", "label", *stack.columns, "prob_stack")


@query("n9_model_diversity", Q.with_views(Q.SCORES) + " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, {rnd(f'corr({a}, {b})', 6)} AS value FROM scores"
    for a in COLS for b in COLS))
def n9(spark, d):
    return rounded(A.full_matrix(A.pair_statistics(views.scores(spark, d), COLS)), ["value"])


@query("n10_model_comparison", Q.with_views(Q.LONG_SCORES, AUC_BY_MODEL, """cells AS (SELECT model,
count(*) FILTER (label = 1 AND p >= 0.4) AS tp, count(*) FILTER (label = 0 AND p >= 0.4) AS fp,
count(*) FILTER (label = 0 AND p < 0.4) AS tn, count(*) FILTER (label = 1 AND p < 0.4) AS fn FROM long_scores GROUP BY 1)""") + f"""
SELECT model, {rnd('auc', 6)} AS auc, {rnd('2.0 * tp / (2 * tp + fp + fn)', 6)} AS f1,
{rnd('CAST(tp + tn AS DOUBLE) / (tp + fp + tn + fn)', 6)} AS accuracy FROM aucs JOIN cells USING (model)
ORDER BY auc DESC, model""")
def n10(spark, d):
    out = E.score_table(views.long_scores(spark, d), "label", "p", 0.4, ["model"])
    return rounded(out, ["auc", "f1", "accuracy"]).orderBy(F.desc("auc"), "model")


def eight_scores(scored, weights):
    """Five base scores, their mean, their weighted mean and the stack, rounded to four digits."""
    base = [f"prob_{n}" for n in BASE]
    wide = scored.withColumn("__w", weights).select(
        "CustomerID", *[C.half_up(F.col(c), 4).alias(c) for c in base],
        C.half_up(N.soft_vote(base), 4).alias("prob_soft_avg"),
        C.half_up(N.weighted(base, F.col("__w")), 4).alias("prob_weighted"),
        C.half_up(F.col("prob_stack"), 4).alias("prob_stack"))
    label = C.threshold_label(F.col("prob_stack"), 0.5, "Churn", "Active")
    return wide.withColumn("prediction", label).orderBy(F.desc("prob_stack"), "CustomerID")


@query("n11_multi_model_scores")
def n11(spark, d):
    data = churn_data(spark, d)
    stack = N.fit_blend(data.train, data.val, "CustomerID", BASE)
    weights = N.auc_weights(N.score_all(stack.base, data.val), "label", list(stack.columns))
    return eight_scores(stack.score(data.rows), weights)
