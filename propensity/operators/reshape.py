"""Unions, complements, schema alignment, wide to long."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def append_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b)


def align_columns(df: DataFrame, wanted: Sequence[str], fill=0) -> DataFrame:
    """Exactly the wanted columns in order: missing ones filled, extra ones dropped."""
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(fill).alias(c) for c in wanted])


def rows_not_in(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    return df.join(other.select(key), key, "left_anti")


def to_long(df: DataFrame, ids: Sequence[str], cols: Sequence[str], name: str = "metric",
            value: str = "value") -> DataFrame:
    return df.select(*ids, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        list(ids), list(cols), name, value)
