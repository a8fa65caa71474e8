"""Subscriber views derived from the order, customer and event tables.

Every view aggregates the large table by its key before joining, so a key that holds
a large share of the rows is reduced on the map side and each join sees unique keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from propensity.functions import columns as C
from propensity.sources.tables import table

# Fixed values of the derivation: plan of each market segment.
PLAN_OF_SEGMENT = {
    "HOUSEHOLD": "trial",
    "BUILDING": "basic",
    "FURNITURE": "standard",
    "AUTOMOBILE": "standard",
    "MACHINERY": "premium",
}
DEVICES = ["smart_tv", "mobile", "tablet", "web"]
PRIORITIES = {1: "1-URGENT", 2: "2-HIGH", 3: "3-MEDIUM", 4: "4-NOT SPECIFIED", 5: "5-LOW"}
LABEL_DAYS = 365

# Coefficients of the written score formulas
# (intercept, recency in years, orders / 10, fee / 25, tenure / 60).
SCORE_FORMULAS = {
    "rf": (-1.4, 0.9, -0.6, 0.2, -0.3),
    "gbm": (-1.1, 1.1, -0.9, 0.1, 0.1),
    "xgb": (-0.9, 0.7, -1.2, 0.4, 0.2),
    "lgb": (-1.6, 1.3, -0.4, -0.2, 0.4),
    "lasso": (-1.0, 0.5, -0.8, 0.3, -0.1),
}
MODELS = list(SCORE_FORMULAS)


def cutoff(spark: SparkSession, sf_dir: str) -> Column:
    """Last day features may look at: one year before the last order (scalar subquery)."""
    day = F.to_date("o_orderdate")
    return (table(spark, sf_dir, "orders")
            .agg(F.date_sub(F.max(day), LABEL_DAYS).alias("cutoff")).scalar())


def order_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer with orders: features up to the cut-off, label after it."""
    day = F.to_date("o_orderdate")
    orders = (table(spark, sf_dir, "orders")
              .select("o_custkey", "o_totalprice", "o_orderpriority",
                      day.alias("day"), cutoff(spark, sf_dir).alias("cutoff")))
    seen = F.col("day") <= F.col("cutoff")
    # day and priority digit in one number: a string or struct buffer would make Spark sort
    # every partition instead of hashing; of two orders on one day the less urgent counts
    rank = F.substring("o_orderpriority", 1, 1).try_cast("int")
    return (orders.groupBy(F.col("o_custkey").alias("custkey"))
            .agg(F.min(F.when(seen, F.col("day"))).alias("first_day"),
                 F.max(F.when(seen, F.col("day"))).alias("last_day"),
                 F.max("day").alias("last_day_any"),
                 F.max("cutoff").alias("cutoff"),
                 F.count_if(seen).alias("n_orders"),
                 F.sum(F.when(seen, F.col("o_totalprice"))).alias("total_spend"),
                 F.max(F.when(seen, F.unix_date("day") * 10 + rank)).alias("packed"))
            .withColumn("last_priority", C.recode((F.col("packed") % 10).cast("int"), PRIORITIES))
            .select("custkey", "n_orders", "total_spend", "last_priority", "last_day",
                    (F.col("total_spend") / F.col("n_orders") / 10000).alias("monthly_fee_usd"),
                    F.floor(F.date_diff("cutoff", "first_day") / 30).cast("int")
                    .alias("tenure_months"),
                    F.date_diff("cutoff", "last_day").alias("recency_days"),
                    C.flag(F.col("last_day_any") <= F.col("cutoff")).alias("churned")))


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with id, plan and balance; no place names, so no joins."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("custkey"),
        C.member_id(F.col("c_custkey")).alias("subscriber_id"),
        C.recode(F.col("c_mktsegment"), PLAN_OF_SEGMENT).alias("plan"),
        F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"),
        F.col("c_nationkey").alias("nationkey"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return (members(spark, sf_dir)
            .join(nation, F.col("nationkey") == F.col("n_nationkey"), "left")
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
            .select("custkey", "subscriber_id", "plan", "segment", "balance",
                    F.col("n_name").alias("country"), F.col("r_name").alias("region")))


def subscribers(spark: SparkSession, sf_dir: str) -> DataFrame:
    feats = order_features(spark, sf_dir).drop("churned", "last_day")
    return customers(spark, sf_dir).join(feats, "custkey", "left")


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pass over the events: viewing and support measures of each user."""
    kind = F.col("event_type")
    errors = kind == "error"
    return (table(spark, sf_dir, "events")
            .select("user_id", "event_type", "value", F.to_date("ts").alias("day"))
            .groupBy(F.col("user_id").alias("custkey"))
            .agg(F.count_distinct("day").alias("days_active"),
                 F.sum("value").alias("total_value"),
                 F.count_if(kind == "view").alias("content_starts"),
                 F.count_if(kind == "purchase").alias("n_purchase"),
                 F.count_if(kind == "click").alias("n_click"),
                 F.count_if(errors).alias("support_tickets"),
                 F.count_if(errors & (F.col("value") > 50)).alias("payment_failures"),
                 F.count_if(errors & (F.col("value") <= 5)).alias("login_failures"),
                 (F.count_if(kind == "signup") % 4).alias("plan_changes")))


def viewing(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = activity(spark, sf_dir)
    device = F.element_at(F.array(*[F.lit(d) for d in DEVICES]),
                          (F.col("custkey") % len(DEVICES) + 1).cast("int"))
    return a.select("custkey",
                    (F.col("total_value") / F.col("days_active") / 24).alias("avg_daily_hours"),
                    "days_active", "content_starts",
                    (F.col("n_purchase") / (F.col("n_click") + 1)).alias("completion_rate"),
                    "total_value", device.alias("device_type"))


def support(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity(spark, sf_dir).select("custkey", "support_tickets", "payment_failures",
                                          "login_failures", "plan_changes")


def churn_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_features(spark, sf_dir).select("custkey", "churned")


def subscriber_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subscribers with viewing, support and label columns; no activity counts as zero."""
    wide = (customers(spark, sf_dir)
            .join(order_features(spark, sf_dir), "custkey", "left")
            .join(activity(spark, sf_dir), "custkey", "left"))
    counts = ["days_active", "content_starts", "support_tickets", "payment_failures",
              "login_failures", "plan_changes"]
    device = F.element_at(F.array(*[F.lit(d) for d in DEVICES]),
                          (F.col("custkey") % len(DEVICES) + 1).cast("int"))
    hours = F.col("total_value") / F.col("days_active") / 24
    rate = F.col("n_purchase") / (F.col("n_click") + 1)
    return wide.select(
        "custkey", "subscriber_id", "plan", "country", "region", "balance",
        "n_orders", "total_spend", "monthly_fee_usd", "tenure_months", "recency_days",
        F.when(F.col("days_active").isNotNull(), device).alias("device_type"),
        F.coalesce(hours, F.lit(0.0)).alias("avg_daily_hours"),
        F.coalesce(rate, F.lit(0.0)).alias("completion_rate"),
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in counts],
        "churned")


def churn(spark: SparkSession, sf_dir: str, everyone: bool = False) -> DataFrame:
    """The churn table: charges, three categorical columns, nulls in TotalCharges.

    With `everyone` also customers without an order before the cut-off, who can be scored but not
    learned from: their tenure and charges are null.
    """
    features = order_features(spark, sf_dir)
    if not everyone:
        features = features.filter(F.col("n_orders") > 0)
    spent = (table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("custkey"))
             .agg(F.sum("value").alias("TotalCharges")))
    return (customers(spark, sf_dir)
            .join(features, "custkey", "left" if everyone else "inner")
            .join(spent, "custkey", "left")
            .select(F.col("custkey").alias("CustomerID"),
                    F.col("tenure_months").alias("tenure"),
                    (F.col("monthly_fee_usd") * 3).alias("MonthlyCharges"),
                    "TotalCharges",
                    F.col("segment").alias("Contract"),
                    F.col("region").alias("InternetService"),
                    F.col("last_priority").alias("PaymentMethod"),
                    F.col("churned").alias("Churn")))


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user, item, rating) from quantities. Lines are summed per order and part first."""
    lines = (table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_partkey")
             .agg(F.sum("l_quantity").alias("qty"), F.count("*").alias("n")))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"))
            .agg((1 + (F.sum("qty") / F.sum("n") - 1) / 49 * 4).alias("rating")))


def weekly_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per priority and week; a week at either end counts only if the days of the data reach its ends."""
    week, day = F.to_date(F.date_trunc("week", F.col("o_orderdate"))), F.to_date("o_orderdate")
    weekly = (table(spark, sf_dir, "orders").select("o_orderpriority", week.alias("week"), day.alias("day"))
              .groupBy(F.col("o_orderpriority").alias("series"), "week")
              .agg(F.count("*").alias("y"), F.min("day").alias("first"), F.max("day").alias("last")))
    ends = weekly.agg(F.struct(F.min("first").alias("lo"), F.max("last").alias("hi"))).scalar()
    return (weekly.withColumn("ends", ends)
            .filter((F.col("week") >= F.col("ends.lo")) & (F.date_add("week", 6) <= F.col("ends.hi")))
            .select("series", "week", "y"))


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.col("l_extendedprice").alias("loan_amount"),
        "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus")


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five written logistic scores (rounded to four digits) with the churn label."""
    base = (order_features(spark, sf_dir).filter(F.col("n_orders") > 0)
            .join(members(spark, sf_dir).select("custkey", "subscriber_id", "plan"), "custkey"))
    return base.select("custkey", "subscriber_id", "plan", F.col("churned").alias("label"),
                       *[formula_score(m).alias(f"p_{m}") for m in MODELS])


def formula_score(model: str) -> Column:
    """A written score over order features, rounded to four digits."""
    b0, recency, orders, fee, tenure = SCORE_FORMULAS[model]
    z = (f"{b0}D + {recency}D * (recency_days / 365.0D) + {orders}D * (n_orders / 10.0D)"
         f" + {fee}D * (monthly_fee_usd / 25.0D) + {tenure}D * (tenure_months / 60.0D)")
    return F.expr(f"floor(1.0D / (1.0D + exp(-({z}))) * 10000.0D + 0.5D) / 10000.0D")


def long_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (subscriber, model)."""
    wide = scores(spark, sf_dir)
    return (wide.unpivot(["custkey", "label"], [f"p_{m}" for m in MODELS], "model", "p")
            .withColumn("model", F.substring("model", 3, 20)))
