"""Lags and differences of weekly series. One row per series and week goes in,
so the longest series is bounded by the calendar whatever the table size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def add_lags(df: DataFrame, series: str, time: str, y: str, lags: Sequence[int]) -> DataFrame:
    w = Window.partitionBy(series).orderBy(time)
    return df.select("*", *[F.lag(y, k).over(w).alias(f"{y}_lag{k}") for k in lags])


def difference(df: DataFrame, series: str, time: str, y: str, order: int, name: str) -> DataFrame:
    """The order-th difference of y; the first `order` rows are null."""
    w = Window.partitionBy(series).orderBy(time)
    sign, binom, terms = 1, 1, None
    for k in range(order + 1):
        part = F.lit(sign * binom) * (F.lag(y, k).over(w) if k else F.col(y))
        terms = part if terms is None else terms + part
        sign, binom = -sign, binom * (order - k) // (k + 1)
    return df.withColumn(name, terms)
