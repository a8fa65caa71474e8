"""Exact nearest neighbours as one partitioned join.

Equal vectors are one point with a count. Points go to the cell of their nearest pivot;
pivots are drawn from the points, so dense regions get more cells. For each cell the
triangle inequality gives a radius that surely holds k neighbours of every point in it,
and a point is copied only to the cells whose radius it can reach. The result is exact:
a copy is left out only where the bound proves it is not among the k nearest.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.functions import columns as C
from propensity.operators.ordered import top_n
from propensity.session import keep

MAX_PIVOTS = 4096  # pivots go to every task: at most this many vectors
BLOCK = 256  # rows of a distance block inside a task
TASK = 1 << 13  # points that a task places, or copies that it compares, about
CELLS = 1 << 22  # distances that a task holds at a time
WIDTH = 1024  # columns of it
SLACK = 1e-9  # relative room for rounding in the bounds
SCHEMA = pa.schema([("pid", pa.int64()), ("neighbours", pa.list_(pa.struct([
    ("distance", pa.float64()), ("pid", pa.int64()), ("copies", pa.int64()), ("v", pa.list_(pa.float64()))])))])


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances, one row per row of a."""
    out = np.empty((len(a), len(b)))
    for j in range(0, len(b), WIDTH):
        part = b[j:j + WIDTH]
        out[:, j:j + WIDTH] = np.sqrt(((a[:, None, :] - part[None, :, :]) ** 2).sum(axis=2))
    return out


def distinct_points(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(pid, v, copies): the smallest key stands for all rows with the same vector."""
    return df.groupBy(F.col(vector).alias("v")).agg(
        F.min(key).alias("pid"), F.count("*").alias("copies"))


def nearest(points: DataFrame, k: int, pivots: int | None = None) -> DataFrame:
    """For each (pid, v, copies) row the k nearest other points, nearest first.

    Returns pid and neighbours: array<struct<distance, pid, copies, v>>.
    """
    points = keep(points.select("pid", "v", "copies"))
    n = points.count()
    count = pivots or int(min(MAX_PIVOTS, max(1, np.sqrt(n))))
    chosen = points.orderBy(C.key_hash("pid"), "pid").limit(count).select("v").collect()
    centre = np.array([r.v for r in chosen], dtype=float).reshape(len(chosen), -1)
    if n <= 1:
        return points.select("pid", F.array().cast(
            "array<struct<distance:double,pid:bigint,copies:bigint,v:array<double>>>")
            .alias("neighbours"))
    handle = points.sparkSession.sparkContext.broadcast(centre)

    @F.pandas_udf("cell int, reach double")
    def locate(v: pd.Series) -> pd.DataFrame:
        x = np.stack(v.to_numpy())
        cells, reach = [], []
        for i in range(0, len(x), BLOCK):
            d = distances(x[i:i + BLOCK], handle.value)
            best = d.argmin(axis=1)
            cells.append(best)
            reach.append(d[np.arange(len(best)), best])
        return pd.DataFrame({"cell": np.concatenate(cells).astype("int32"),
                             "reach": np.concatenate(reach)})

    # points are small and work per point is not: the number of tasks follows the points, not their bytes
    parts = -(-n // TASK)
    placed = keep(points.repartition(parts, "pid").withColumn("at", locate("v")).select(
        "pid", "v", "copies", F.col("at.cell").alias("cell"), F.col("at.reach").alias("reach")))

    # per cell: its radius, and the k + 1 points closest to the pivot (one may be the point itself)
    radius = np.zeros(len(centre))
    for cell, r in placed.groupBy("cell").agg(F.max("reach")).collect():
        radius[cell] = r
    close = top_n(placed.select("cell", "reach", "pid"), ["cell"], ["reach", "pid"], k + 1)
    near = np.full((len(centre), k + 1), np.inf)
    for cell, reach, rank in close.select("cell", "reach", "rank").collect():
        near[cell, rank - 1] = reach
    enough = np.empty(len(centre))
    for i in range(len(centre)):
        upper = (distances(centre[i:i + 1], centre)[0][:, None] + near).ravel()
        enough[i] = radius[i] + np.partition(upper, min(k, len(upper) - 1))[min(k, len(upper) - 1)]
    bounds = points.sparkSession.sparkContext.broadcast((radius, enough * (1 + SLACK) + SLACK))

    @F.pandas_udf("array<int>")
    def reached(v: pd.Series, cell: pd.Series) -> pd.Series:
        rad, need = bounds.value
        x, own = np.stack(v.to_numpy()), cell.to_numpy()
        out = []
        for i in range(0, len(x), BLOCK):
            d = distances(x[i:i + BLOCK], handle.value)
            mine = own[i:i + BLOCK]
            home = d[np.arange(len(mine)), mine][:, None]
            gap = distances(handle.value[mine], handle.value)
            with np.errstate(divide="ignore", invalid="ignore"):
                plane = np.where(gap > 0, (d ** 2 - home ** 2) / (2 * gap), 0.0)
            hit = (d - rad <= need) & (plane <= need)
            hit[np.arange(len(mine)), mine] = True
            out += [np.flatnonzero(h).astype("int32") for h in hit]
        return pd.Series(out)

    copied = placed.repartition(parts, "pid").withColumn("target", F.explode(reached("v", "cell"))).select(
        "target", (F.col("target") == F.col("cell")).alias("own"), "pid", "copies", "v")

    def closest(table: pa.Table) -> pa.Table:
        ids, many = (table.column(c).to_numpy() for c in ("pid", "copies"))
        own = np.flatnonzero(table.column("own").to_numpy())
        if not len(own):
            return SCHEMA.empty_table()
        x = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
        block, most = max(1, min(BLOCK, CELLS // len(x))), min(k, len(x))
        takes, gaps = [], []
        for i in range(0, len(own), block):
            mine = own[i:i + block]
            d = distances(x[mine], x)
            d[np.arange(len(mine)), mine] = np.inf
            d[np.isnan(d)] = np.inf
            bound = np.partition(d, most - 1, axis=1)[:, most - 1]
            for row, last in zip(d, bound):
                near = np.flatnonzero((row <= last) & np.isfinite(row))
                take = near[np.lexsort((ids[near], row[near]))[:k]]
                takes.append(take)
                gaps.append(row[take])
        flat = np.concatenate(takes)
        ends = np.cumsum([0] + [len(t) for t in takes]).astype(np.int32)
        vectors = pa.ListArray.from_arrays(np.arange(len(flat) + 1, dtype=np.int32) * x.shape[1], pa.array(x[flat].ravel()))
        found = pa.StructArray.from_arrays([pa.array(np.concatenate(gaps)), pa.array(ids[flat]), pa.array(many[flat]), vectors],
                                           ["distance", "pid", "copies", "v"])
        return pa.table([pa.array(ids[own]), pa.ListArray.from_arrays(pa.array(ends), found)], ["pid", "neighbours"])

    # a cell may get copies of many points, so cells are dealt to more tasks than the points are
    cells = min(len(centre), 4 * parts)
    return copied.repartition(cells, "target").groupBy("target").applyInArrow(
        closest, "pid bigint, neighbours array<struct<distance:double,pid:bigint,copies:bigint,v:array<double>>>")
