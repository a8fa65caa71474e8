"""Whole scorecards (C): from tables to segment counts, top lists and written scores."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from propensity.functions import columns as C
from propensity.operators import aggregates as A
from propensity.operators import ensemble as N
from propensity.operators import features as X
from propensity.operators import forecast as T
from propensity.operators import joins as J
from propensity.operators import linear
from propensity.operators import metrics as E
from propensity.operators import models as M
from propensity.operators import records as L
from propensity.operators import sampling, tuning
from propensity.operators import subscribers as S
from propensity.plans import view_sql as Q
from propensity.plans.column_queries import RISK_SQL, TIER_SQL, ltv_tier, risk_segment
from propensity.plans.ensemble_queries import BASE, FINAL, eight_scores
from propensity.plans.loan_job import KEYS, errors, loan_frames
from propensity.plans.model_queries import (OUTLIER_COLS, outlier_sql, rating_rows, value_rows)
from propensity.plans.prepared import CHURN_COLUMNS, churn_data
from propensity.plans.registry import query, rnd
from propensity.session import keep, new_path
from propensity.sources import sinks, tables, views

# ---- churn ---------------------------------------------------------------------------


def churn_rows(spark, d):
    """All subscribers with assembled features; those with an order before the cut-off split 80/20, the
    others (no tenure, no fee, no label) are only scored: split `new`."""
    df = S.plan_flags(views.subscriber_features(spark, d)).fillna(0, ["tenure_months", "monthly_fee_usd"])
    df = sampling.with_split(df, "subscriber_id", {"train": 0.8, "test": 0.2})
    df = df.withColumn("split", F.when(F.col("n_orders") > 0, F.col("split")).otherwise("new"))
    return keep(X.assemble(df, CHURN_COLUMNS).select(
        "subscriber_id", F.col("churned").alias("label"), "features", "split"))


@query("c1_churn_risk_segments")
def c1(spark, d):
    rows = churn_rows(spark, d)
    forest = M.fit("churn_forest", rows.filter(F.col("split") == "train"))
    scored = M.score(forest, rows)
    return A.group_summary(scored.withColumn("risk_segment", risk_segment(F.col("prob"))),
                           "risk_segment", {"avg_prob": "prob"})


@query("c1_churn_model_metrics")
def c1b(spark, d):
    rows = churn_rows(spark, d)
    train, test = (rows.filter(F.col("split") == s) for s in ("train", "test"))
    models = M.fit_many({n: (lambda n=n: M.fit(n, train)) for n in ("churn_logistic", "churn_forest")})
    parts = [M.score(m, test).select(F.lit(n).alias("model"), "label", "prob") for n, m in models.items()]
    cells = E.confusion(parts[0].unionByName(parts[1]), "label", F.col("prob") >= 0.5, ["model"])
    return E.rates(cells, ["accuracy", "precision", "recall", "f1"])


# ---- lifetime value ------------------------------------------------------------------

@query("c2_value_tiers")
def c2(spark, d):
    rows = value_rows(spark, d)
    model = M.fit("value_boosted", rows.filter(F.col("split") == "train"))
    scored = model.transform(rows).withColumn("ltv_tier", ltv_tier(F.col("prediction")))
    return A.group_summary(scored, "ltv_tier", {"avg_ltv": "prediction"})


@query("c2_value_model_errors")
def c2b(spark, d):
    rows = value_rows(spark, d)
    train, test = (rows.filter(F.col("split") == s) for s in ("train", "test"))
    models = M.fit_many({"value_linear": lambda: M.fit("value_linear", train),
                         "value_boosted": lambda: M.fit("value_boosted", train)})
    parts = [m.transform(test).select(F.lit(n).alias("model"), "label", "prediction")
             for n, m in models.items()]
    return E.regression_errors(parts[0].unionByName(parts[1]), "label", "prediction", ["model"])


# ---- recommendation ------------------------------------------------------------------

@query("c3_recommendation_error")
def c3(spark, d):
    rows = rating_rows(spark, d)
    fitted = M.fit_recommender(rows).transform(rows).filter(~F.isnan("prediction"))
    return E.regression_errors(fitted, "rating", "prediction").select("rmse", "mae")


# ---- conversion and upsell -----------------------------------------------------------

CONVERSION_COLUMNS = ["balance", "avg_daily_hours", "days_active", "completion_rate",
                      "content_starts", "support_tickets"]
UPSELL_COLUMNS = ["is_standard", "balance", "tenure_months", "monthly_fee_usd", "avg_daily_hours",
                  "completion_rate", "content_starts", "plan_changes", "support_tickets"]


@query("c4_conversion_priority")
def c4(spark, d):
    df = S.conversion_label(views.subscriber_features(spark, d).filter(F.col("plan") == "trial"))
    df = sampling.with_split(df, "subscriber_id", {"train": 0.8, "test": 0.2})
    rows = keep(X.assemble(df, CONVERSION_COLUMNS).select(
        "subscriber_id", F.col("converted").alias("label"), "features", "split"))
    model = M.fit("conversion_logistic", rows.filter(F.col("split") == "train"))
    scored = M.score(model, rows).withColumn("priority", S.conversion_priority(F.col("prob")))
    return A.group_summary(scored, "priority")


@query("c5_upsell_top")
def c5(spark, d):
    df = views.subscriber_features(spark, d).filter(
        F.col("plan").isin("basic", "standard")).fillna(0, ["tenure_months", "monthly_fee_usd"])
    df = S.upgrade_label(S.plan_flags(df.withColumn("genres_watched", F.col("plan_changes"))))
    df = sampling.with_split(df, "subscriber_id", {"train": 0.8, "test": 0.2})
    rows = keep(X.assemble(df, UPSELL_COLUMNS).select(
        "subscriber_id", F.col("upgraded").alias("label"), "features", "split"))
    model = M.fit("upsell_logistic", rows.filter(F.col("split") == "train"))
    return M.score(model, rows).select("subscriber_id", F.col("prob").alias("upsell_probability")).orderBy(
        F.desc("upsell_probability"), "subscriber_id").limit(10)


# ---- fraud, demand, master table -----------------------------------------------------

def fraud_scores(rows):
    return linear.flag_outliers(linear.mahalanobis(rows, OUTLIER_COLS), "outlier_score")


_FRAUD_SQL = outlier_sql(OUTLIER_COLS)


@query("c6_fraud_flags", f"""SELECT is_suspicious, count(*) AS n, {rnd('count(*) * 100.0 / sum(count(*)) OVER ()', 4)} AS pct,
{rnd('avg(outlier_score)', 3)} AS mean_score FROM ({_FRAUD_SQL}) GROUP BY 1""")
def c6(spark, d):
    rows = keep(S.fraud_signals(views.subscriber_features(spark, d)).select(
        "subscriber_id", *OUTLIER_COLS, "fraud_score_raw"))
    out = fraud_scores(rows).withColumn("outlier_score", C.half_up(F.col("outlier_score"), 4))
    table = A.group_summary(out, "is_suspicious", {"mean_score": "outlier_score"}, {"mean_score": 3})
    return A.share_of_total(table).withColumn("pct", C.half_up(F.col("pct"), 4))


@query("c7_demand_forecast")
def c7(spark, d):
    weekly = views.weekly_orders(spark, d)
    total = weekly.groupBy("week").agg(F.sum("y").alias("y")).withColumn("series", F.lit("all"))
    return T.forecast(weekly.unionByName(total), 12)


def master_scores(spark, d):
    """One row per subscriber: churn, value and outlier scores with the resulting action."""
    rows = keep(views.subscriber_features(spark, d))
    # every score is a function of these rows, so no join is needed
    wide = fraud_scores(rows).withColumn("churn_probability", views.formula_score("rf")).withColumn(
        "predicted_ltv_usd", F.col("total_spend") / 10000)
    wide = wide.withColumns({"risk_segment": risk_segment(F.col("churn_probability")),
                             "ltv_tier": ltv_tier(F.col("predicted_ltv_usd"))})
    return wide.select(
        "subscriber_id", "plan", "tenure_months", "monthly_fee_usd", "churn_probability", "risk_segment",
        "predicted_ltv_usd", "ltv_tier", "outlier_score", "is_suspicious",
        S.action_priority(F.col("is_suspicious"), F.col("risk_segment"), F.col("ltv_tier"))
        .alias("action_priority"))


_MASTER = Q.with_views(Q.SCORES) + f""", fraud AS ({_FRAUD_SQL}), m AS (
SELECT c.subscriber_id, s.p_rf AS churn_probability, {RISK_SQL.format(p='s.p_rf')} AS risk,
 o.total_spend / 10000 AS ltv, {TIER_SQL.format(x='(o.total_spend / 10000)')} AS tier, is_suspicious
FROM customers c LEFT JOIN scores s USING (custkey) LEFT JOIN order_features o USING (custkey) LEFT JOIN fraud USING (custkey)),
a AS (SELECT *, CASE WHEN is_suspicious = 1 THEN 'Investigate fraud'
 WHEN risk = 'High' AND tier IN ('Platinum', 'Gold') THEN 'VIP save — immediate'
 WHEN risk = 'High' THEN 'High-priority save'
 WHEN risk = 'Medium' AND tier = 'Platinum' THEN 'Proactive engagement'
 ELSE 'Standard monitoring' END AS action_priority FROM m)"""


@query("c8_master_scores", _MASTER + f"""
SELECT action_priority, count(*) AS n, {rnd('avg(ltv)', 2)} AS avg_ltv, {rnd('avg(churn_probability)', 3)} AS avg_churn_pr
FROM a GROUP BY 1 ORDER BY n DESC, action_priority""")
def c8(spark, d):
    out = A.group_summary(master_scores(spark, d), "action_priority",
                          {"avg_ltv": "predicted_ltv_usd", "avg_churn_pr": "churn_probability"},
                          {"avg_ltv": 2, "avg_churn_pr": 3})
    return out.orderBy(F.desc("n"), "action_priority")


@query("c8_master_table", _MASTER + f"""
SELECT subscriber_id, churn_probability, risk AS risk_segment, {rnd('ltv', 4)} AS predicted_ltv_usd, tier AS ltv_tier,
is_suspicious, action_priority FROM a""")
def c8b(spark, d):
    path = sinks.write_dataset(master_scores(spark, d), new_path(spark, "master"))
    return tables.load_dataset(spark, path).select(
        "subscriber_id", "churn_probability", "risk_segment",
        C.half_up(F.col("predicted_ltv_usd"), 4).alias("predicted_ltv_usd"), "ltv_tier",
        "is_suspicious", "action_priority")


@query("c8_fitted_master")
def c8_fitted(spark, d):
    """The three score tables of fitted models, joined to every subscriber."""
    churn = churn_rows(spark, d)
    churn_scores = M.score(M.fit("churn_forest", churn.filter(F.col("split") == "train")), churn).select(
        "subscriber_id", F.col("prob").alias("churn_probability"), risk_segment(F.col("prob")).alias("risk_segment"))
    value = value_rows(spark, d)
    value_scores = M.fit("value_boosted", value.filter(F.col("split") == "train")).transform(value).select(
        "subscriber_id", F.col("prediction").alias("predicted_ltv_usd"), ltv_tier(F.col("prediction")).alias("ltv_tier"))
    rows = keep(views.subscriber_features(spark, d))
    outliers = fraud_scores(rows).select("subscriber_id", "outlier_score", "is_suspicious")
    wide = rows.select("subscriber_id", "plan", "tenure_months", "monthly_fee_usd")
    for scores in (churn_scores, value_scores, outliers):
        wide = wide.join(scores, "subscriber_id", "left")
    return wide.withColumn("action_priority", S.action_priority(F.col("is_suspicious"), F.col("risk_segment"), F.col("ltv_tier")))


# ---- batch scoring -------------------------------------------------------------------

@query("c9_batch_churn_scoring")
def c9(spark, d):
    data = churn_data(spark, d)
    model = M.fit("churn_logistic", data.train)
    sweep = E.threshold_sweep(M.score(model, data.val), "label", "prob", E.grid(10, 90, 5))
    best = E.best_threshold(sweep).first()
    threshold = (best["pct"] if best and best["pct"] is not None else 50) / 100
    bundle = L.save_bundle(spark, {"churn": PipelineModel([*data.encoder.stages, model])},
                           {"threshold": threshold, "version": "v1.0"})
    # a later run: only the bundle and the new rows
    models, details = L.load_bundle(spark, bundle)
    new = views.churn(spark, d, everyone=True).drop("Churn")
    scored = M.score(models["churn"], X.charge_columns(new)).select(
        "CustomerID", C.half_up(F.col("prob"), 4).alias("prob_churn"))
    scored = scored.withColumn("prediction", C.threshold_label(
        F.col("prob_churn"), float(details["threshold"]), "Churn", "Active"))
    full = J.join_back(new, scored, "CustomerID")
    path = sinks.append_by_date(full, new_path(spark, "churn-scores"), "2024-01-31")
    return tables.load_dataset(spark, path).select(
        "CustomerID", "tenure", "MonthlyCharges", "prob_churn", "prediction", "score_date"
    ).orderBy(F.desc("prob_churn"), "CustomerID")


@query("c9_formula_scoring", Q.with_views(Q.SCORES) + """
SELECT c.custkey, c.plan, c.balance, s.p_gbm AS prob_churn, CASE WHEN s.p_gbm >= 0.35 THEN 'Churn'
WHEN s.p_gbm < 0.35 THEN 'Active' END AS prediction, '2024-01-31' AS score_date
FROM customers c LEFT JOIN scores s USING (custkey) ORDER BY prob_churn DESC NULLS LAST, custkey""")
def c9b(spark, d):
    """The batch steps with a written score: threshold, join back, append by date, rank."""
    new = views.members(spark, d).select("custkey", "plan", "balance")
    scored = views.scores(spark, d).select(
        "custkey", F.col("p_gbm").alias("prob_churn"),
        C.threshold_label(F.col("p_gbm"), 0.35, "Churn", "Active").alias("prediction"))
    full = J.join_back(new, scored, "custkey")
    path = sinks.append_by_date(full, new_path(spark, "formula-scores"), "2024-01-31")
    schema = full.schema.add("score_date", "string")
    return tables.load_dataset(spark, path, schema=schema).orderBy(F.desc_nulls_last("prob_churn"), "custkey")


@query("c10_ensemble_scoring")
def c10(spark, d):
    data = churn_data(spark, d)
    stack = N.fit_stack(data.train, "CustomerID", BASE, 5, final=FINAL)
    long = N.score_all(stack.base, data.val)
    weights = E.auc_roc(long.unpivot(["label"], list(stack.columns), "model", "p"), "label", "p", ["model"]).collect()
    total = sum(r.auc for r in weights)
    path = L.save_bundle(spark, {
        "encoder": data.encoder, "meta": stack.meta, **{f"base_{n}": m for n, m in stack.base.items()}},
        {f"weight_{r.model}": r.auc / total for r in weights})
    models, details = L.load_bundle(spark, path)
    again = N.Stack({n: models[f"base_{n}"] for n in BASE}, models["meta"], stack.columns)
    w = F.struct(*[F.lit(float(details[f"weight_{c}"])).alias(c) for c in stack.columns])
    everyone = X.charge_columns(views.churn(spark, d, everyone=True))
    new = models["encoder"].transform(everyone).select("CustomerID", "features")
    return eight_scores(again.score(new), w)


@query("c11_loan_regression")
def c11(spark, d):
    train, test = loan_frames(spark, d)
    grid = tuning.combinations({"maxDepth": [3, 7], "minInstancesPerNode": [10, 50]})
    row, test = F.concat_ws("|", *KEYS), test.repartition(spark.sparkContext.defaultParallelism)
    best, _, plain = tuning.amount_search(train.withColumn("row", row), "row", "loan_forest", grid, 5)
    return errors(M.score(plain, test, "prediction")).withColumn("model", F.lit("forest")).unionByName(
        errors(M.score(best, test, "prediction")).withColumn("model", F.lit("tuned")))
