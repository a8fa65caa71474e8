"""Training frames shared by the model queries: written once per call, then only read."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensity.operators import sampling
from propensity.operators.features import FeatureSet, charge_columns, feature_names
from propensity.session import keep
from propensity.sources import views

CHURN_FEATURES = FeatureSet(
    ("tenure", "tenure_sq", "avg_charges", "MonthlyCharges", "TotalCharges", "high_value", "charge_ratio"),
    ("Contract", "InternetService", "PaymentMethod"))


@dataclass(frozen=True)
class ChurnData:
    rows: DataFrame  # CustomerID, label, features, split
    encoder: PipelineModel
    raw: DataFrame

    @property
    def train(self) -> DataFrame:
        return self.rows.filter(F.col("split") == "train")

    @property
    def val(self) -> DataFrame:
        return self.rows.filter(F.col("split") == "val")

    @property
    def test(self) -> DataFrame:
        return self.rows.filter(F.col("split") == "test")

    @property
    def names(self) -> list[str]:
        return feature_names(self.encoder.transform(self.raw.limit(0)))


def churn_data(spark: SparkSession, sf_dir: str) -> ChurnData:
    """Churn rows split 70/15/15; imputer, indexes and encoder fitted on the training part."""
    raw = charge_columns(views.churn(spark, sf_dir)).withColumn("label", F.col("Churn"))
    raw = keep(sampling.with_split(raw, "CustomerID", {"train": 0.7, "val": 0.15, "test": 0.15}))
    encoder = CHURN_FEATURES.fit(raw.filter(F.col("split") == "train"))
    # fits pass over these rows many times: the encoded ones are kept, too
    rows = keep(encoder.transform(raw).select("CustomerID", "label", "features", "split"))
    return ChurnData(rows, encoder, raw)


# Columns of the subscriber models.
CHURN_COLUMNS = ["balance", "tenure_months", "monthly_fee_usd", "avg_daily_hours", "days_active",
                 "content_starts", "completion_rate", "support_tickets", "payment_failures",
                 "plan_changes", "is_trial", "is_premium", "low_activity"]
VALUE_COLUMNS = ["balance", "tenure_months", "monthly_fee_usd", "avg_daily_hours", "completion_rate",
                 "content_starts", "support_tickets", "plan_changes", "is_premium", "is_trial",
                 "engagement_score"]
