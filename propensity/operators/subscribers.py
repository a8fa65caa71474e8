"""Derived subscriber columns: value, conversion, upgrade and fraud signals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.functions import columns as C
from propensity.functions import fixed_values as V


def value_columns(df: DataFrame) -> DataFrame:
    """Engagement and an estimated lifetime value: fee x months x service factor."""
    engagement = F.col("avg_daily_hours") / 3 * F.col("completion_rate")
    months = C.at_least(F.col("tenure_months") + 12 * F.col("engagement_score"), 1.0)
    service = C.at_least(1 - 0.1 * F.col("support_tickets"), 0.5)
    return (df.withColumn("engagement_score", engagement)
            .withColumn("estimated_ltv_usd", F.col("monthly_fee_usd") * months * service))


def plan_flags(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "is_trial": C.flag(F.col("plan") == "trial"),
        "is_premium": C.flag(F.col("plan") == "premium"),
        "is_standard": C.flag(F.col("plan") == "standard"),
        "low_activity": C.flag(F.col("days_active") < V.LOW_ACTIVITY_DAYS),
    })


def conversion_label(df: DataFrame) -> DataFrame:
    index = (F.col("avg_daily_hours") * 0.4 + F.col("completion_rate") * 0.3
             + F.col("days_active") / 30 * 0.3)
    return df.withColumn("converted", C.flag(index > V.CONVERSION_CUT))


def upgrade_label(df: DataFrame) -> DataFrame:
    index = (F.col("avg_daily_hours") * 0.35 + F.col("genres_watched") * 0.04
             + F.col("completion_rate") * 0.25 + F.col("tenure_months") * 0.005)
    return df.withColumn("upgraded", C.flag(index > V.UPGRADE_CUT))


def fraud_signals(df: DataFrame) -> DataFrame:
    hours, starts = F.col("avg_daily_hours"), F.col("content_starts")
    idle = C.flag(hours < V.LOW_HOURS)
    return df.withColumns({
        "unusual_login": C.flag(F.col("login_failures") > V.LOGIN_FAILURE_LIMIT),
        "payment_issues": C.flag(F.col("payment_failures") > V.PAYMENT_FAILURE_LIMIT),
        "low_content": C.flag((hours < V.LOW_HOURS) & (starts < V.LOW_STARTS)),
        "multi_device": C.flag((F.col("device_type") == "web") & (starts > V.MANY_STARTS)),
        "fraud_score_raw": (F.col("login_failures") * 0.3 + F.col("payment_failures") * 0.4
                            + idle * 0.3),
    })


def conversion_priority(p):
    return C.first_match([(p >= cut, text) for cut, text in V.CONVERSION_PRIORITY],
                         V.CONVERSION_DEFAULT)


def action_priority(suspicious, risk, tier):
    """What to do with a subscriber, from fraud flag, risk segment and value tier."""
    high = risk == "High"
    return C.first_match([
        (suspicious == 1, V.ACTION_FRAUD),
        (high & tier.isin("Platinum", "Gold"), V.ACTION_VIP),
        (high, V.ACTION_HIGH),
        ((risk == "Medium") & (tier == "Platinum"), V.ACTION_PROACTIVE),
    ], V.ACTION_DEFAULT)
