"""Keyed joins used to build feature and score tables. Join strategy is left to AQE."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_chain(base: DataFrame, others: Sequence[DataFrame], key: str) -> DataFrame:
    """Left-join each frame in turn; every one must be unique on the key."""
    return reduce(lambda left, right: left.join(right, key, "left"), others, base)


def full_outer(frames: Sequence[DataFrame], key: str) -> DataFrame:
    return reduce(lambda a, b: a.join(b, key, "full"), frames)


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once; empty when a join on them adds no rows."""
    return df.groupBy(key).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def join_back(rows: DataFrame, scored: DataFrame, key: str) -> DataFrame:
    """All original rows with their score columns."""
    new = [c for c in scored.columns if c == key or c not in rows.columns]
    return rows.join(scored.select(*new), key, "left")


def with_endpoints(edges: DataFrame, nodes: DataFrame, node_key: str, names: Sequence[str],
                   source: str = "from", target: str = "to") -> DataFrame:
    """Add the node columns of both ends of each edge."""
    out = edges
    for end in (source, target):
        side = nodes.select(F.col(node_key).alias(end),
                            *[F.col(n).alias(f"{end}_{n}") for n in names])
        out = out.join(side, end, "left")
    return out


def parameter_grid(base: DataFrame, grid: dict[str, Sequence]) -> DataFrame:
    """Every combination of the parameter values for each row of `base`.

    The values are a fixed list, so each row becomes a fixed number of rows in place.
    """
    out = base
    for name, values in grid.items():
        out = out.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return out
