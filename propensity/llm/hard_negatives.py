"""Hard negatives: candidate blocks in Hilbert order, zone maps, and interval bounds that choose what is read.

Vectors become whole numbers. Rows are sorted by label and by their place on a Hilbert curve and packed to blocks, written as
Parquet rows with the least and largest value of each dimension. For an anchor the inner product with any row of a block lies
between two sums over these values: a block is read for the anchor only if that interval meets what the anchor looks
for, its best rows of the same label first (beyond the fifth best of its own block), then its windows of scores.

Anchors are a stated query set; they are taken in groups against pages of zone maps, then against the blocks chosen. A task
holds one group and one block or page at a time, each of bounded size. In many dimensions intervals are wide, so most blocks may have
to be read: the work is then anchors times rows, in blocks.

Defined cases. Rows with a null vec_id, label or vector, or with a null or non-finite component, take no part. Of rows with one
vec_id the one with the smallest label, dimension and numbers takes part. Rows of different dimension have no score. Scores have to
fit 64 bits. An anchor without rows of its label, or whose windows hold nothing, has no row. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from propensity.session import keep

BLOCK_ROWS = 1024
GROUP_ANCHORS = 256
PAGE_BLOCKS = 1024
BITS = 4  # per dimension of the curve
SCALE = 256
POSITIVES, NEGATIVES = 5, 5
LOWEST = np.iinfo(np.int64).min


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> list[bytes]:
    """Place on the Hilbert curve of every row of cells (rows x dimensions, values below 2^bits), as sortable bytes.

    The transposed form: bit planes of all dimensions, from the highest.
    """
    x = cells.astype(np.uint32).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # undo what finer planes inherit: invert or exchange the low bits
        p = np.uint32(q - 1)
        for i in range(n):
            on = (x[i] & q) != 0
            t = np.where(on, 0, (x[0] ^ x[i]) & p).astype(np.uint32)
            x[0] = np.where(on, x[0] ^ p, x[0] ^ t)
            x[i] ^= t
        q >>= 1
    for i in range(1, n):  # Gray code
        x[i] ^= x[i - 1]
    t = np.zeros(x.shape[1], np.uint32)
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ np.uint32(q - 1), t) if n else t
        q >>= 1
    x ^= t
    planes = np.concatenate([(x >> b) & 1 for b in range(bits - 1, -1, -1)]).astype(np.uint8) if n else np.zeros((0, len(cells)), np.uint8)
    return [r.tobytes() for r in np.packbits(planes.T, axis=1)]


def packed(values: np.ndarray) -> bytes:
    """Whole numbers in 2 bytes each if they fit, else in 8; the size tells which."""
    small = not values.size or (values.min() >= -(1 << 15) and values.max() < 1 << 15)
    return values.astype("<i2" if small else "<i8").tobytes()


def unpacked(data: bytes, rows: int, dim: int) -> np.ndarray:
    kind = "<i8" if rows * dim and len(data) == 8 * rows * dim else "<i2"
    return np.frombuffer(data, kind).reshape(rows, dim)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of a and b."""
    if a.dtype.itemsize == 2 and b.dtype.itemsize == 2 and a.shape[1] < 1 << 22:
        return (a.astype(float) @ b.T.astype(float)).astype(np.int64)  # below 2^53
    return a.astype(np.int64) @ b.T.astype(np.int64)


def bounds(a: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, largest) inner product of each anchor with any vector between lo and hi of each block."""
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    return products(up, lo) + products(down, hi), products(up, hi) + products(down, lo)


def _numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, labels, dims, data, top = [], [], [], [], []
        for i, label, v in zip(batch.column(0), batch.column(1), batch.column(2)):
            if not v.is_valid or v.values.null_count:
                continue
            x = np.floor(SCALE * np.asarray(v.values, float))
            if not np.isfinite(x).all():
                continue
            x = x.astype(np.int64)
            ids.append(i.as_py())
            labels.append(label.as_py())
            dims.append(len(x))
            data.append(packed(x))
            top.append(int(np.abs(x).max()) if len(x) else 0)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(labels, pa.int64()), pa.array(dims, pa.int32()),
                                          pa.array(data, pa.binary()), pa.array(top, pa.int64())], ["id", "label", "dim", "vec", "top"])


def whole_numbers(vectors: DataFrame) -> DataFrame:
    """(id, label, dim, vec, top): one usable row per id, labels shifted where the id is divisible by 7."""
    label = F.col("label").cast("bigint")
    rows = vectors.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()).select(
        F.col("vec_id").cast("bigint").alias("id"), F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
        F.col("embedding").cast("array<double>").alias("v"))
    rows = rows.mapInArrow(_numbers, "id bigint, label bigint, dim int, vec binary, top bigint")
    first = rows.groupBy("id").agg(F.min(F.struct("label", "dim", "vec", "top")).alias("r"))
    return first.select("id", "r.*")


def _with_keys(top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(2).to_numpy()
            keys = np.empty(len(dims), object)
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                x = np.array([unpacked(batch.column(3)[int(k)].as_py(), 1, dim)[0] for k in rows], np.int64).reshape(len(rows), dim)
                cells = ((x + top).astype(float) * (1 << BITS) / (2 * top + 1)).astype(np.uint32)
                keys[rows] = hilbert_keys(np.minimum(cells, (1 << BITS) - 1))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(keys.tolist(), pa.binary())], ["id", "label", "dim", "vec", "key"])

    return run


PACK_SCHEMA = ("kind string, block bigint, grp bigint, dim int, label bigint, n int, ids binary, data binary, lo binary, hi binary")


def _pack(block_rows: int, group_anchors: int):
    """Sorted rows to blocks with zone maps, and the anchors among them to groups; both of one label and dimension.

    A group row carries, as `hi`, the fifth best score of each anchor inside its own block.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 32
        block, group = base, base
        ids: list[int] = []
        vecs: list[bytes] = []
        anchors: list[tuple[int, np.ndarray, int]] = []
        at = None
        out: list[tuple] = []

        def end_block() -> None:
            nonlocal block, ids, vecs
            label, dim = at
            x = np.array([unpacked(v, 1, dim)[0] for v in vecs], np.int64).reshape(len(vecs), dim)
            i = np.array(ids, np.int64)
            out.append(("block", block, None, dim, label, len(i), i.tobytes(), packed(x), packed(x.min(axis=0)), packed(x.max(axis=0))))
            for k in np.flatnonzero(i % 100 == 0):
                others = np.sort(np.delete(products(x[k:k + 1], x)[0], k))[::-1]
                anchors.append((int(i[k]), x[k], int(others[POSITIVES - 1]) if len(others) >= POSITIVES else LOWEST))
            block += 1
            ids, vecs = [], []

        def end_group() -> None:
            nonlocal group, anchors
            label, dim = at
            while anchors:
                part, anchors = anchors[:group_anchors], anchors[group_anchors:]
                out.append(("group", None, group, dim, label, len(part), np.array([p[0] for p in part], np.int64).tobytes(),
                            packed(np.array([p[1] for p in part], np.int64).reshape(len(part), dim)), None,
                            np.array([p[2] for p in part], np.int64).tobytes()))
                group += 1

        def give() -> Iterator[pa.RecordBatch]:
            nonlocal out
            if out:
                columns = [c.split() for c in PACK_SCHEMA.split(", ")]
                kinds = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
                yield pa.RecordBatch.from_arrays([pa.array(v, kinds[t]) for v, (_, t) in zip(zip(*out), columns)], [c for c, _ in columns])
                out = []

        for batch in batches:
            for i, label, dim, vec in zip(*(batch.column(k) for k in range(4))):
                now = (label.as_py(), dim.as_py())
                if ids and (now != at or len(ids) >= block_rows):
                    end_block()
                if anchors and (now != at or len(anchors) >= group_anchors):
                    end_group()
                at = now
                ids.append(i.as_py())
                vecs.append(vec.as_py())
            yield from give()
        if ids:
            end_block()
            end_group()
        yield from give()

    return run


CHOSEN_SCHEMA = "block bigint, m int, ids binary, data binary, wanted binary"


def _choose(same_label: bool):
    """(group, page) rows to the blocks of the page that some anchors of the group have to read, with those anchors.

    `wanted` holds, per anchor, the least score looked for, then the largest (of windows: the extremes that its windows reach).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                a = unpacked(r["data"], r["n"], r["dim"])
                ids = np.frombuffer(r["ids"], np.int64)
                wanted = np.frombuffer(r["wanted"], np.int64).reshape(r["n"], -1, 2)
                zones = [z for z in r["zones"] if z["dim"] == r["dim"] and (z["label"] == r["label"]) == same_label]
                out = []
                if zones:
                    lo, hi = (np.concatenate([unpacked(z[c], 1, r["dim"]) for z in zones]) for c in ("lo", "hi"))
                    least, most = bounds(a, lo, hi)
                    need = np.zeros(least.shape, bool)
                    for w in range(wanted.shape[1]):
                        need |= (most >= wanted[:, w, :1]) & (least <= wanted[:, w, 1:]) & (wanted[:, w, :1] <= wanted[:, w, 1:])
                    for b in np.flatnonzero(need.any(axis=0)):
                        k = np.flatnonzero(need[:, b])
                        out.append((zones[b]["block"], len(k), ids[k].tobytes(), packed(a[k].astype(np.int64)), wanted[k].tobytes()))
                blocks, m, names, data, w = zip(*out) if out else ((), (), (), (), ())
                yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array(m, pa.int32()), *[
                    pa.array(x, pa.binary()) for x in (names, data, w)]], [c.split()[0] for c in CHOSEN_SCHEMA.split(", ")])

    return run


def _read(limit: int):
    """Chosen blocks to the best rows for each window of each anchor: (anchor, window, id, score)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                a, x = unpacked(r["data"], r["m"], r["dim"]), unpacked(r["rows"], r["n"], r["dim"])
                anchors, ids = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["row_ids"], np.int64)
                wanted = np.frombuffer(r["wanted"], np.int64).reshape(r["m"], -1, 2)
                scores = products(a, x)
                out: list[np.ndarray] = []
                for k in range(r["m"]):
                    order = np.lexsort((ids, -scores[k]))
                    order = order[ids[order] != anchors[k]]
                    falling = -scores[k, order]
                    for w, (low, high) in enumerate(wanted[k]):
                        start = np.searchsorted(falling, -high, "left")
                        pick = order[start:start + limit]
                        pick = pick[scores[k, pick] >= low]
                        if len(pick):
                            out.append(np.stack([np.full(len(pick), anchors[k]), np.full(len(pick), w), ids[pick], scores[k, pick]]))
                got = np.concatenate(out, axis=1) if out else np.zeros((4, 0), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in got], ["anchor", "window", "id", "score"])

    return run


def search(groups: DataFrame, blocks: DataFrame, pages: DataFrame, n_pages: int, same_label: bool, limit: int) -> DataFrame:
    """(anchor, window, id, score): per window of each anchor at least its best `limit` rows, read from the blocks whose bounds allow."""
    spread = groups.withColumn("page", F.explode(F.sequence(F.lit(0), F.lit(n_pages - 1))))
    met = spread.join(pages, "page").select("dim", "label", "n", "ids", "data", "wanted", "zones")
    chosen = met.mapInArrow(_choose(same_label), CHOSEN_SCHEMA)
    rows = blocks.select("block", "dim", "n", F.col("ids").alias("row_ids"), F.col("data").alias("rows"))
    return chosen.join(rows, "block").drop("block").mapInArrow(_read(limit), "anchor bigint, window bigint, id bigint, score bigint")


def best(rows: DataFrame, by: list[str], limit: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "id")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= limit)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups and their positives to the score windows of each anchor: from four fifths of a positive's score up to it."""
    for batch in batches:
        wanted = []
        for n, ids, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            place = {int(i): k for k, i in enumerate(np.frombuffer(ids, np.int64))}
            w = np.zeros((n, POSITIVES, 2), np.int64)
            w[:, :, 0], w[:, :, 1] = 1, 0  # nothing
            for f in found or ():
                p = f["score"]
                w[place[f["anchor"]], f["rank"] - 1] = (-(-4 * p // 5), p)
            wanted.append(w.tobytes())
        yield pa.RecordBatch.from_arrays([*batch.columns[3:], pa.array(wanted, pa.binary())], [*batch.schema.names[3:], "wanted"])


def hard_negatives(vectors: DataFrame, block_rows: int = BLOCK_ROWS, group_anchors: int = GROUP_ANCHORS,
                   page_blocks: int = PAGE_BLOCKS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    spark = vectors.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = keep(whole_numbers(vectors))
    top = rows.agg(F.max("top")).first()[0] or 1
    keyed = rows.mapInArrow(_with_keys(max(top, 1)), "id bigint, label bigint, dim int, vec binary, key binary")
    order = ["dim", "label", "key", "id"]
    packs = keep(keyed.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(_pack(block_rows, group_anchors), PACK_SCHEMA))
    blocks = packs.filter("kind = 'block'").drop("kind", "grp")
    groups = packs.filter("kind = 'group'").select("grp", "dim", "label", "n", "ids", "data", "hi")
    n_pages = -(-blocks.count() // page_blocks) or 1
    pages = keep(blocks.withColumn("page", F.pmod(F.xxhash64("block"), F.lit(n_pages)).cast("int")).groupBy("page").agg(
        F.collect_list(F.struct("block", "dim", "label", "lo", "hi")).alias("zones")))

    ids = groups.select("grp", "n", "ids").mapInArrow(_members, "grp bigint, anchor bigint")
    near = groups.mapInArrow(_open_windows, "grp bigint, dim int, label bigint, n int, ids binary, data binary, wanted binary")
    positives = keep(best(search(near, blocks, pages, n_pages, True, POSITIVES), ["anchor"], POSITIVES).select(
        "anchor", "rank", F.col("id").alias("positive_id"), "score"))
    found = positives.join(ids, "anchor").groupBy("grp").agg(F.collect_list(F.struct("anchor", "rank", "score")).alias("found"))
    far = groups.join(found, "grp").select("n", "ids", "found", "grp", "dim", "label", F.col("n").alias("n_"), F.col("ids").alias("ids_"), "data")
    far = far.mapInArrow(_windows, "grp bigint, dim int, label bigint, n_ int, ids_ binary, data binary, wanted binary")
    far = far.withColumnsRenamed({"n_": "n", "ids_": "ids"})
    negatives = best(search(far, blocks, pages, n_pages, False, NEGATIVES), ["anchor", "window"], NEGATIVES)
    named = positives.select("anchor", (F.col("rank") - 1).cast("bigint").alias("window"), "positive_id", F.col("score").alias("positive_score"))
    return negatives.join(named, ["anchor", "window"]).select(
        F.col("anchor").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = [np.frombuffer(x, np.int64) for x in batch.column(2).to_pylist()]
        groups = np.repeat(batch.column(0).to_numpy(), [len(x) for x in ids])
        yield pa.RecordBatch.from_arrays([pa.array(groups, pa.int64()), pa.array(np.concatenate(ids) if ids else [], pa.int64())], ["grp", "anchor"])


def _open_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One window per anchor, from the fifth best score of its own block upwards."""
    for batch in batches:
        wanted = []
        for x in batch.column(6).to_pylist():
            low = np.frombuffer(x, np.int64)
            wanted.append(np.stack([low, np.full(len(low), np.iinfo(np.int64).max)], axis=1).tobytes())
        yield pa.RecordBatch.from_arrays([*batch.columns[:6], pa.array(wanted, pa.binary())], [*batch.schema.names[:6], "wanted"])
