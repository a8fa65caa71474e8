"""Conversations as a prefix trie: balanced parentheses per shard, shared spines merged.

Conversations are sorted by the digests of their turns, which is depth-first order of the trie, and cut
into shards. A shard writes its part of the trie as parentheses, one pair a node, with minima of excess per
block: `find_close` delimits subtrees, counts of leaf pairs and cumulative sums over the places
give what lies inside. Nodes on the first or last path of a shard (its spines) may go on in other shards: their parts
are put together in one more trie, of two paths a shard, and the sums of whole subtrees below them are added.

A conversation is one row of 16 bytes and a number per turn; texts are never shuffled. A shard is cut after a bounded number
of nodes, so a task's memory follows that bound and the longest conversation. Ids of the conversations that end in a node
are hashed in ascending order, in pieces, so a group of copies of any size needs no memory of its own.

Defined cases. Rows without conv_id are left out. Turns with equal numbers are ordered by the SHA-256 of their role and
text; repeated rows are turns like others. Null role or text is empty. An empty table has no nodes. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.session import keep

SHARD_SIZE = 1 << 17  # nodes and conversations
BLOCK = 256  # parentheses per block of the excess index
DIGEST = 16


class Parentheses:
    """A sequence of opening (1) and closing (0) parentheses with a tree of block minima of excess."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits.astype(np.int8)
        self.excess = np.cumsum(2 * self.bits.astype(np.int32) - 1, dtype=np.int32)
        n = -(-max(len(bits), 1) // BLOCK)
        padded = np.full(n * BLOCK, np.iinfo(np.int32).max, np.int32)
        padded[:len(bits)] = self.excess
        size = 1 << (n - 1).bit_length()
        self.minima = np.full(2 * size, np.iinfo(np.int32).max, np.int32)
        self.minima[size:size + n] = padded.reshape(n, BLOCK).min(axis=1)
        for k in range(size - 1, 0, -1):
            self.minima[k] = min(self.minima[2 * k], self.minima[2 * k + 1])
        self.leaves = size
        pairs = np.zeros(len(bits), np.int64)
        pairs[:-1] = (self.bits[:-1] == 1) & (self.bits[1:] == 0)
        self.leaf_pairs = np.concatenate([[0], np.cumsum(pairs)])  # before each place
        self.opens = np.concatenate([[0], np.cumsum(self.bits, dtype=np.int64)])

    def _scan(self, place: np.ndarray, goal: np.ndarray) -> np.ndarray:
        """First place from `place` to the end of its block with excess below the goal + 1; -1 if there is none."""
        found = np.full(len(place), -1, np.int64)
        end = np.minimum((place // BLOCK + 1) * BLOCK, len(self.bits))
        left, at = np.arange(len(place)), place.copy()
        while len(left):
            left = left[at[left] < end[left]]
            hit = self.excess[at[left]] <= goal[left]
            found[left[hit]] = at[left[hit]]
            left = left[~hit]
            at[left] += 1
        return found

    def find_close(self, opens: np.ndarray) -> np.ndarray:
        """Place of the parenthesis that closes each of the opening ones."""
        goal = self.excess[opens] - 1
        out = self._scan(opens + 1, goal)
        far = np.flatnonzero(out < 0)
        if len(far):
            node = self.leaves + opens[far] // BLOCK
            want = goal[far]
            # up until a right sibling holds the goal, then down to its first block that does
            up = np.ones(len(far), bool)
            while up.any():
                right = (node & 1 == 0) & (self.minima[np.minimum(node + 1, 2 * self.leaves - 1)] <= want)
                node = np.where(up & right, node + 1, np.where(up, node >> 1, node))
                up &= ~right
            while (node < self.leaves).any():
                inner = node < self.leaves
                first = self.minima[np.where(inner, 2 * node, 0)] <= want
                node = np.where(inner, np.where(first, 2 * node, 2 * node + 1), node)
            out[far] = self._scan((node - self.leaves) * BLOCK, want)
        return out

    def leaves_inside(self, opens: np.ndarray, closes: np.ndarray) -> np.ndarray:
        return self.leaf_pairs[closes] - self.leaf_pairs[opens]


class Trie:
    """A trie built from sorted paths; nodes are numbered in the order in which they open (0 is the root)."""

    def __init__(self) -> None:
        self.bits: list[int] = [1]
        self.parent, self.depth = [-1], [0]
        self.path = [0]  # open nodes, root first

    def __len__(self) -> int:
        return len(self.parent)

    def go(self, shared: int, length: int) -> None:
        """The next path: its first `shared` turns are those of the path before, `length` in all."""
        for _ in range(len(self.path) - 1 - shared):
            self.path.pop()
            self.bits.append(0)
        for d in range(shared + 1, length + 1):
            self.parent.append(self.path[-1])
            self.depth.append(d)
            self.path.append(len(self.parent) - 1)
            self.bits.append(1)

    def close(self) -> None:
        self.bits += [0] * len(self.path)
        self.parens = Parentheses(np.array(self.bits, np.int8))
        self.parents, self.depths = np.array(self.parent), np.array(self.depth)
        self.open_at = np.flatnonzero(self.parens.bits)
        self.close_at = self.parens.find_close(self.open_at)
        self.last = self.parens.opens[self.close_at]  # nodes of the subtree are numbers node .. last - 1
        self.n_leaves = self.parens.leaves_inside(self.open_at, self.close_at)

    def inside(self, values: np.ndarray) -> np.ndarray:
        """Sum of a node value over each subtree."""
        total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
        return total[self.last] - total[:-1]

    def least(self, values: np.ndarray) -> np.ndarray:
        """Smallest node value of each subtree."""
        out = values.copy()
        order = np.argsort(-self.depths, kind="stable")
        for level in np.split(order, np.flatnonzero(np.diff(self.depths[order])) + 1):
            if self.depths[level[0]]:
                np.minimum.at(out, self.parents[level], out[level])
        return out

    def children(self) -> np.ndarray:
        return np.bincount(self.parents[1:], minlength=len(self))


NONE = np.iinfo(np.int64).max


def common(a: bytes, b: bytes) -> int:
    """Turns that two paths of digests share from the start."""
    n = min(len(a), len(b)) // DIGEST
    if a[:n * DIGEST] == b[:n * DIGEST]:
        return n
    lo, hi = 0, n  # the first lo turns agree, the first hi do not
    while hi - lo > 1:
        mid = (lo + hi) // 2
        lo, hi = (mid, hi) if a[:mid * DIGEST] == b[:mid * DIGEST] else (lo, mid)
    return lo


def chain(path: bytes) -> list[bytes]:
    """A name for every prefix of a path: a digest of the name before and the turn's digest."""
    names = [b"\0" * DIGEST]
    for i in range(0, len(path), DIGEST):
        names.append(hashlib.sha256(names[-1] + path[i:i + DIGEST]).digest()[:DIGEST])
    return names


SHARD_SCHEMA = ("kind string, shard bigint, place bigint, node binary, parent binary, conv_id bigint, depth bigint, parent_conv_id bigint, "
                "n_convs bigint, n_children bigint, n_leaves bigint, saved bigint, chars bigint, ends string")


class Shard:
    """Sorted conversations of one range; gives whole nodes, parts of spine nodes, and ids that end in spine nodes."""

    def __init__(self, number: int):
        self.number, self.trie = number, Trie()
        self.first = self.last = None
        self.chars, self.ended = [0], [0]
        self.least_id = [NONE]
        self.ends: dict[int, list[int]] = {}
        self.size = 0  # nodes and conversations

    def add(self, conv_id: int, path: bytes, chars: list[int]) -> None:
        n = len(path) // DIGEST
        shared = 0 if self.last is None else common(self.last, path)
        self.trie.go(shared, n)
        self.chars += chars[shared:]
        self.ended += [0] * (n - shared)
        self.least_id += [NONE] * (n - shared)
        top = self.trie.path[-1]
        self.ended[top] += 1
        self.least_id[top] = min(self.least_id[top], conv_id)
        self.ends.setdefault(top, []).append(conv_id)
        self.first = path if self.first is None else self.first
        self.last = path
        self.size += 1 + n - shared

    def rows(self) -> Iterator[pa.RecordBatch]:
        t = self.trie
        t.close()
        chars = np.array(self.chars, np.int64)
        n_convs, least = t.inside(np.array(self.ended)), t.least(np.array(self.least_id, np.int64))
        own = (n_convs - 1) * chars
        names: dict[int, bytes] = {}
        first, last = chain(self.first), chain(self.last)
        names |= dict(enumerate(first))  # the first path opens nodes 0, 1, 2, ...
        names |= {node: last[d] for d, node in enumerate(t.path)}
        spine = np.zeros(len(t), bool)
        spine[list(names)] = True
        whole = np.flatnonzero(~spine)
        # sums that leave spine nodes out: those come in when their parts are put together
        saved = t.inside(np.where(spine, 0, own))
        children = t.children()
        outer = np.bincount(t.parents[whole], minlength=len(t))
        childless = children == 0
        leaves = np.where(spine, t.inside(childless & ~spine), t.n_leaves)
        order = np.concatenate([whole, np.flatnonzero(spine)])
        text = {v: ",".join(map(str, ids)) for v, ids in self.ends.items()}
        for at in range(0, len(order), 1 << 16):
            part = order[at:at + (1 << 16)]
            up = t.parents[part]
            top = spine[part]
            lost = spine[np.maximum(up, 0)] & (up >= 0)
            digest = [text.get(v, "") if s else hashlib.sha256(text.get(v, "").encode()).hexdigest() for v, s in zip(part.tolist(), top)]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.where(top, "spine", "whole")), pa.array(np.full(len(part), self.number)), pa.array(part),
                pa.array([names.get(v) for v in part.tolist()], pa.binary()),
                pa.array([names.get(v) if s else None for v, s in zip(up.tolist(), lost)], pa.binary()),
                pa.array(least[part], mask=least[part] == NONE), pa.array(t.depths[part].astype(np.int64)),
                pa.array(least[np.maximum(up, 0)], mask=lost | (up < 0)),
                pa.array(n_convs[part]), pa.array(np.where(top, outer[part], children[part])), pa.array(leaves[part].astype(np.int64)),
                pa.array(saved[part]), pa.array(chars[part]), pa.array(digest, pa.string())],
                [c.split()[0] for c in SHARD_SCHEMA.split(", ")])


def _shards(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        shard = Shard(number)
        for batch in batches:
            ids, paths, chars = (batch.column(i) for i in range(3))
            for k in range(batch.num_rows):
                if shard.size >= size:
                    yield from shard.rows()
                    number += 1
                    shard = Shard(number)
                shard.add(ids[k].as_py(), paths[k].as_py(), chars[k].as_py())
        if shard.first is not None:
            yield from shard.rows()

    return run


SPINE_PARTS = ("node", "depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved", "chars")
SPINE_SCHEMA = ("node binary, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, "
                "n_leaves bigint, saved_tokens bigint")


def _merge_spines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of spine nodes, in order of shards and inside one by depth-first order, to whole nodes.

    Paths are named by their nodes, so a node that several shards hold is opened once.
    """
    trie, names, index = Trie(), [], {}
    sums: list[list[int]] = []
    for batch in batches:
        for r in batch.to_pylist():
            v = index.get(r["node"])
            if v is None:
                if r["depth"]:
                    trie.go(r["depth"] - 1, r["depth"])
                v = index[r["node"]] = len(names)
                names.append(r["node"])
                sums.append([0, 0, 0, 0, r["chars"], NONE])
            s = sums[v]
            for k, c in enumerate(("n_convs", "n_children", "n_leaves", "saved")):
                s[k] += r[c]
            s[5] = min(s[5], r["conv_id"])
    if not names:
        return
    trie.close()
    n_convs, outer, leaves, saved, chars, least = (np.array(x, np.int64) for x in zip(*sums))
    children = trie.children() + outer
    # leaves and savings below a spine node: outer ones of its own shards are counted in every part already,
    # so only spine nodes are added along the trie
    n_leaves = leaves + trie.inside(children == 0)
    total = saved + trie.inside((n_convs - 1) * chars)
    yield pa.RecordBatch.from_arrays([
        pa.array(names, pa.binary()), pa.array(least), pa.array(trie.depths.astype(np.int64)),
        pa.array(least[np.maximum(trie.parents, 0)], mask=trie.parents < 0), pa.array(n_convs), pa.array(children),
        pa.array(n_leaves), pa.array(total)], [c.split()[0] for c in SPINE_SCHEMA.split(", ")])


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, pieces of ids) in order to one SHA-256 per node; holds one state, whatever the number of ids."""
    node, state, some = None, hashlib.sha256(), False
    for batch in batches:
        names, digests = [], []
        for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if name != node:
                if node is not None:
                    names.append(node)
                    digests.append(state.hexdigest())
                node, state, some = name, hashlib.sha256(), False
            if text:
                state.update((("," if some else "") + text).encode())
                some = True
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(digests, pa.string())], ["node", "ends_sha256"])
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([state.hexdigest()])], ["node", "ends_sha256"])


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): turns in order, each (turn, digest, chars)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    # the length tells where the role ends
    named = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    digest = F.substring(F.unhex(F.sha2(named, 256)), 1, DIGEST)
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.struct(F.col("turn"), digest.alias("digest"), F.length(text).cast("bigint").alias("chars")).alias("t"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, path, chars) after the first h turns came from the conversation that begins the hundred."""
    base = F.col("conv_id") - F.col("conv_id") % 100
    heads = turns.filter(F.col("conv_id") % 100 == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, 5).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6).cast("int")
    own = F.when(F.size("turns") > h, F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0))))
    none = F.slice("turns", 1, 0)
    both = F.concat(F.coalesce(F.slice("head", 1, h), none), F.coalesce(own, none))
    rows = turns.withColumn("base", base).join(heads, "base", "left").select("conv_id", both.alias("turns"))
    return rows.select("conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), "")).alias("path"),
                       F.col("turns.chars").alias("chars"))


def prefix_nodes(conversations: DataFrame, shard_size: int = SHARD_SIZE) -> DataFrame:
    """One row per trie node of the rebuilt conversations.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    n = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    paths = rebuilt(turns_of(conversations)).repartitionByRange(n, "path", "conv_id").sortWithinPartitions("path", "conv_id")
    parts = keep(paths.mapInArrow(_shards(shard_size), SHARD_SCHEMA))
    spine = parts.filter("kind = 'spine'")
    # two paths a shard: their number follows that of the shards, not of the rows
    merged = keep(spine.select("shard", "place", *SPINE_PARTS).repartition(1).sortWithinPartitions(
        "shard", "place").mapInArrow(_merge_spines, SPINE_SCHEMA))
    ends = (spine.select("node", "ends", "shard").repartition(n, "node").sortWithinPartitions("node", "shard")
            .select("node", "ends").mapInArrow(_hash_ends, "node binary, ends_sha256 string"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    whole = parts.filter("kind = 'whole'").withColumnsRenamed({"saved": "saved_tokens", "ends": "ends_sha256"})
    inner = whole.filter("parent is null").select(columns)
    names = merged.select(F.col("node").alias("parent"), F.col("conv_id").alias("of_parent"))
    outer = whole.filter("parent is not null").join(names, "parent").withColumn("parent_conv_id", F.col("of_parent")).select(columns)
    return inner.unionByName(outer).unionByName(merged.join(ends, "node").select(columns))
