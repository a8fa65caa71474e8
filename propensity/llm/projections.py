"""Embedding near-duplicates by counting collisions of one-dimensional projections.

Vectors are compared only inside their label. Every vector of length one is projected on
`PROJECTIONS` random directions. For a pair at the wanted cosine the difference of two projections
is normal with a known deviation, so a window of that many deviations around the query holds the
partner with a known probability, and the number of windows a true pair falls into is binomial:
the count a pair must reach is the largest that keeps the wanted recall. Pairs that reach it are
verified with their cosine in double precision.

The first two projections also sort the vectors into cells wider than the window; a query's windows
lie in its own and the neighbouring cells, so only those meet. Cells are cut into blocks of
bounded size and blocks meet block by block: one pair of blocks is a task's unit of work, whatever
part of the table a label or a cell has. A block pair returns sums and a spanning forest, at
most one row per vector, never its pairs.

Equal vectors of a label are one vector with a count. Vectors that are null, zero, or hold null or
non-finite components, and vectors without a label, link with nothing; each is its own class.
Vectors of different length do not link. Repeated ids give one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb, erf, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.llm.components import components
from propensity.session import keep

PROJECTIONS = 24
DEVIATIONS = 2.0  # half width of a window
RECALL = 0.995  # of the collision count, for a pair exactly at the threshold
CELL = 1.5  # width of a cell, in half windows
BLOCK = 1024  # vectors of a block, about
THRESHOLD = 0.98


def collision_rule(threshold: float, projections: int = PROJECTIONS) -> tuple[float, int]:
    """(half window, count to reach): derived from the wanted cosine and recall."""
    half = DEVIATIONS * sqrt(2 - 2 * threshold)
    hit = erf(DEVIATIONS / sqrt(2))
    count, mass = projections, hit ** projections
    while mass < RECALL and count > 0:
        count -= 1
        mass += comb(projections, count) * hit ** count * (1 - hit) ** (projections - count)
    return half, count


def directions(size: int, projections: int = PROJECTIONS) -> np.ndarray:
    return np.random.default_rng(size).standard_normal((size, projections))


def projected(vectors: DataFrame, key: str, vector: str, label: str, threshold: float) -> DataFrame:
    """(id, label, size, digest, c1, c2, vec): vec (doubles as bytes) is null where a vector cannot link."""
    half, _ = collision_rule(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, first, second, data = [], [], [], [], []
            labels = batch.column(1)
            for i, v in enumerate(batch.column(2)):
                x = None if not v.is_valid or not labels[i].is_valid or v.values.null_count else np.asarray(v.values, float)
                if x is None or not len(x) or not np.isfinite(x).all() or not (x != 0).any():
                    x = None
                if x is None:
                    for out in (sizes, digests, first, second, data):
                        out.append(None)
                    continue
                x = x + 0.0  # -0.0 and 0.0 are one value
                unit = x / np.abs(x).max()
                p = unit @ directions_of(len(x))[:, :2] / np.linalg.norm(unit)
                cell = np.floor(p / (CELL * half))
                sizes.append(len(x))
                digests.append(hashlib.blake2b(x.tobytes(), digest_size=16).digest())
                first.append(int(cell[0]))
                second.append(int(cell[1]))
                data.append(x.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), labels, pa.array(sizes, pa.int32()), pa.array(digests, pa.binary()),
                 pa.array(first, pa.int32()), pa.array(second, pa.int32()), pa.array(data, pa.binary())],
                ["id", "label", "size", "digest", "c1", "c2", "vec"])

    rows = vectors.select(F.col(key).cast("bigint").alias("id"), F.col(label).alias("label"), F.col(vector).alias("v"))
    return rows.filter("id is not null").mapInArrow(
        run, f"id bigint, label {dict(rows.dtypes)['label']}, size int, digest binary, c1 int, c2 int, vec binary")


_directions: dict[int, np.ndarray] = {}


def directions_of(size: int) -> np.ndarray:
    if size not in _directions:
        _directions[size] = directions(size)
    return _directions[size]


def block_links(ids_a, copies_a, a: np.ndarray, ids_b, copies_b, b: np.ndarray, same: bool, threshold: float):
    """(id, links, root) of all vectors of two blocks that link across them."""
    half, need = collision_rule(threshold)
    na, nb = np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1)
    r = directions_of(a.shape[1])
    pa_, pb = (a / na[:, None]) @ r, (b / nb[:, None]) @ r
    hits = np.zeros((len(a), len(b)), np.int8)
    for j in range(r.shape[1]):
        # the window of each query, as a range of the sorted projection of the other block
        order = np.argsort(pb[:, j], kind="stable")
        s = pb[order, j]
        lo = np.searchsorted(s, pa_[:, j] - half, "left")
        hi = np.searchsorted(s, pa_[:, j] + half, "right")
        rank = np.empty(len(b), np.int64)
        rank[order] = np.arange(len(b))
        hits += (rank[None, :] >= lo[:, None]) & (rank[None, :] < hi[:, None])
    i, j = np.nonzero(hits >= need)
    if same:
        i, j = i[i < j], j[i < j]
    cosine = np.concatenate([np.einsum("ij,ij->i", a[i[k:k + 65536]], b[j[k:k + 65536]])
                             for k in range(0, len(i), 65536)]) if len(i) else np.zeros(0)
    linked = cosine / (na[i] * nb[j]) >= threshold
    i, j = i[linked], j[linked]
    ids = np.concatenate([ids_a, ids_b])
    at, to = i, j + len(a)
    n = np.bincount(at, weights=copies_b[j], minlength=len(ids)) + np.bincount(to, weights=copies_a[i], minlength=len(ids))
    root = ids.copy()
    while True:
        low = np.minimum(root[at], root[to])
        new = root.copy()
        np.minimum.at(new, at, low)
        np.minimum.at(new, to, low)
        if (new == root).all():
            break
        root = new
    some = n > 0
    return ids[some], n[some].astype(np.int64), root[some]


def find_links(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
               threshold: float = THRESHOLD) -> DataFrame:
    """Per vector: key, n_links (other vectors linked directly), component_id, kept."""
    rows = keep(projected(vectors, key, vector, label, threshold).dropDuplicates(["id"]))
    usable = rows.filter("vec is not null")
    # equal vectors of a label: written before they are joined, so a hot one can be split
    points = keep(usable.groupBy("label", "digest").agg(
        F.min("id").alias("rep"), F.count("*").alias("copies"), *[F.first(c).alias(c) for c in ("size", "c1", "c2", "vec")]))
    cells = ["label", "size", "c1", "c2"]
    sizes = keep(points.groupBy(*cells).agg(F.count("*").alias("n")))
    blocks = points.join(sizes, cells).withColumn(
        "chunk", F.pmod(F.xxhash64("rep"), F.floor((F.col("n") + BLOCK - 1) / BLOCK)))
    blocks = keep(blocks.groupBy(*cells, "chunk").agg(F.collect_list(F.struct("rep", "copies", "vec")).alias("rows")))
    left = blocks.select("label", "size", "c1", "c2", F.col("chunk").alias("chunk_a"), F.col("rows").alias("rows_a"))
    # the cell itself and half of its neighbours: every pair of neighbouring cells once
    steps = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ((0, 0), (0, 1), (1, -1), (1, 0), (1, 1))])
    right = blocks.withColumn("step", F.explode(steps)).select(
        "label", "size", (F.col("c1") + F.col("step.x")).alias("c1"), (F.col("c2") + F.col("step.y")).alias("c2"),
        ((F.col("step.x") == 0) & (F.col("step.y") == 0)).alias("own"), F.col("chunk").alias("chunk_b"), F.col("rows").alias("rows_b"))
    met = left.join(right, cells).filter("not own or chunk_a <= chunk_b").select(
        "size", (F.col("own") & (F.col("chunk_a") == F.col("chunk_b"))).alias("same"), "rows_a", "rows_b")
    found = keep(met.mapInArrow(_meet(threshold), "id bigint, n bigint, root bigint"))
    sums = keep(found.groupBy("id").agg(F.sum("n").alias("n")))
    labels = components(found.select("id", "root").distinct(), "id", "root")
    members = usable.select("id", "label", "digest").join(
        points.select("label", "digest", "rep", "copies"), ["label", "digest"]).select("id", "rep", "copies")
    named = (members.join(sums.withColumnRenamed("id", "rep"), "rep", "left")
             .join(labels.withColumnRenamed("id", "rep"), "rep", "left")
             .select("id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("component", "rep").alias("component")))
    alone = rows.filter("vec is null").select("id", F.lit(0).cast("bigint").alias("n"), F.col("id").alias("component"))
    return named.unionByName(alone).select(
        F.col("id").alias(key), F.col("n").alias("n_links"), F.col("component").alias("component_id"),
        (F.col("id") == F.col("component")).alias("kept"))


def _meet(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                size, same = batch.column(0)[k].as_py(), batch.column(1)[k].as_py()
                sides = []
                for c in (2, 3):
                    rows = batch.column(c)[k].values
                    vec = np.frombuffer(b"".join(v.as_py() for v in rows.field("vec")), float).reshape(-1, size)
                    sides += [rows.field("rep").to_numpy(), rows.field("copies").to_numpy().astype(float), vec]
                ids, n, root = block_links(*sides, same, threshold)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n), pa.array(root)], ["id", "n", "root"])

    return run
