"""Streams (R)."""

from __future__ import annotations

from pyspark.sql import functions as F

from propensity.functions import columns as C
from propensity.operators import models as M
from propensity.plans import view_sql as Q
from propensity.plans.prepared import churn_data
from propensity.plans.registry import query, rnd
from propensity.session import new_path
from propensity.sources import views
from propensity.streaming import jobs


@query("r1_incremental_scoring")
def r1(spark, d):
    data = churn_data(spark, d)
    model = M.fit("tree", data.train)
    when = views.order_features(spark, d).select(F.col("custkey").alias("CustomerID"),
                                                 F.col("last_day").cast("timestamp").alias("seen_at"))
    arrivals = data.raw.join(when, "CustomerID")
    source = new_path(spark, "arrivals")
    arrivals.write.parquet(source)
    arrivals.write.mode("append").parquet(source)  # everything is sent a second time

    def score(batch):
        out = M.score(model, data.encoder.transform(batch)).select("CustomerID", "prob")
        return out.withColumn("prediction", C.threshold_label(F.col("prob"), 0.5, "Churn", "Active"))

    return jobs.score_arrivals(spark, source, arrivals.schema, new_path(spark, "stream-scores"),
                               new_path(spark, "stream-state"), score, "CustomerID", "seen_at",
                               "2024-01-31", "4000 days")


@query("r1_incremental_formula_scores", Q.with_views(Q.SCORES) + """
SELECT custkey, p_rf AS prob, CASE WHEN p_rf >= 0.5 THEN 'Churn' ELSE 'Active' END AS prediction,
'2024-01-31' AS score_date FROM scores""")
def r1b(spark, d):
    rows = views.order_features(spark, d).filter(F.col("n_orders") > 0).select(
        "custkey", "recency_days", "n_orders", "monthly_fee_usd", "tenure_months",
        F.col("last_day").cast("timestamp").alias("seen_at"))
    source = new_path(spark, "arrivals")
    rows.write.parquet(source)
    rows.write.mode("append").parquet(source)  # everything is sent a second time

    def score(batch):
        return batch.select("custkey", views.formula_score("rf").alias("prob")).withColumn(
            "prediction", C.threshold_label(F.col("prob"), 0.5, "Churn", "Active"))

    out = jobs.score_arrivals(spark, source, rows.schema, new_path(spark, "stream-scores"),
                              new_path(spark, "stream-state"), score, "custkey", "seen_at",
                              "2024-01-31", "4000 days")
    return out.select("custkey", "prob", "prediction", F.col("score_date").cast("string").alias("score_date"))


@query("r2_running_activity", f"""SELECT CAST(ts AS DATE) AS day, user_id, count(*) AS n_events,
{rnd('sum(value)', 2)} AS total_value, count(*) FILTER (event_type = 'view') AS content_starts,
count(*) FILTER (event_type = 'error') AS support_tickets FROM events GROUP BY 1, 2""")
def r2(spark, d):
    out = jobs.activity_totals(spark, f"{d}/events.parquet*", new_path(spark, "totals"),
                               new_path(spark, "totals-state"), "60 days")
    return out.withColumn("total_value", C.half_up(F.col("total_value"), 2))
