"""Boosted trees and forests over binned rows: many fits share one table.

Features are cut into quantile bins once and kept as bytes. A tree is grown from histograms: per open node, feature and
bin the sums of first and second derivatives and the number of rows. Derivatives are whole multiples of 2^-20, so sums are exact
and a model does not depend on how rows are partitioned. Row samples and bags are hashes of the row's number and
the tree's, so any job can tell again which trees did not see a row.

Two ways to run, with the same trees as result. `fit_spread`: rows stay in their partitions, every pass adds up the
histograms of all open nodes of all fits (folds, candidates) by tree, and the tasks that add them up search the splits: what reaches
the driver is as large as the models, whatever the rows, bins and partitions. `fit_local`: if the rows are few enough for one task, each fit is a task of one job;
there a tree's rows are dealt to its nodes once, groups of features are counted together, and of two children the smaller is counted.
"""

from __future__ import annotations

import heapq
import json
import pickle
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensity.session import keep, shared_dir

UNIT = float(1 << 20)
PRIME = (1 << 31) - 1
LOCAL_ROWS = 4_000_000  # rows that one task takes whole: some 70 bytes each
LOCAL_COPIES = 500_000_000  # rows times tasks, some 30 bytes each before they are compressed
GROUP = 512  # cells of features that are counted together
COUNTED = 1 << 16  # rows of a node whose sums share a number
MASKED = 1 << 14  # rows from which leaves are found by masks
CELLS = 8_000_000  # histogram cells of one pass
GROWING = 512  # trees of forests that are grown at a time


@dataclass(frozen=True)
class Spec:
    """A boosted model, or a forest (`forest`): trees on the label itself with Poisson bags."""
    rounds: int = 100
    depth: int | None = 5
    leaves: int | None = None  # best leaf first, up to so many; None: level by level
    eta: float = 0.1
    l2: float = 0.0
    l1: float = 0.0
    gamma: float = 0.0  # least gain of a split
    min_weight: float = 0.0  # least second derivative in a child
    min_rows: int = 1
    row_share: float = 1.0  # of boosted trees; the Poisson rate of bags
    bag_every: int = 1
    columns: float = 1.0  # share per tree; in a forest the number per split
    second_order: bool = True  # gain from second derivatives; otherwise from row counts
    from_mean: bool = False  # start at the log-odds of the label instead of 0
    allowed: tuple[int, ...] | None = None  # features that may be split on; None: all
    forest: bool = False
    bagged: bool = True  # a forest's trees see Poisson bags; otherwise every row once
    seed: int = 42


# The published settings of each family.
SPECS = {
    "boosted": Spec(rounds=300, depth=4, eta=0.05, min_rows=10, row_share=0.7, second_order=False, from_mean=True),
    "xgb_like": Spec(rounds=200, depth=5, eta=0.05, l2=1.0, gamma=0.1, min_weight=5.0, row_share=0.8, columns=0.8),
    "lgb_like": Spec(rounds=200, depth=None, leaves=31, eta=0.05, l2=1.0, min_rows=20, row_share=0.8, bag_every=5, columns=0.8,
                     from_mean=True),
    "forest": Spec(rounds=300, depth=8, min_rows=5, forest=True, columns=0.0),
}


# ---- rows

@dataclass
class Rows:
    bins: np.ndarray  # rows x features
    y: np.ndarray
    w: np.ndarray
    number: np.ndarray  # 0 .. PRIME - 1, from a hash of the key
    fold: np.ndarray


def uniform(number: np.ndarray, seed: int, tree: int) -> np.ndarray:
    """A number in [0, 1) per row and tree; whole-number arithmetic, so SQL gives the same."""
    a = 1 + (48271 * (tree + 1) + 69621 * seed) % (PRIME - 1)
    b = (16807 * (tree + 1) + seed) % PRIME
    x = number.astype(np.int64, copy=False) * a + b
    for _ in range(2):  # the remainder by a prime of 31 bits that are all set
        x = (x & PRIME) + (x >> 31)
    return np.where(x == PRIME, 0, x) / PRIME


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = (x + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def poisson_cuts(rate: float, most: int = 12) -> np.ndarray:
    p = np.exp(-rate) * np.cumprod(np.concatenate([[1.0], rate / np.arange(1, most)]))
    return np.cumsum(p)


def bag(number: np.ndarray, spec: Spec, tree: int) -> np.ndarray:
    """How often a tree sees each row."""
    if not spec.bagged or not spec.forest and spec.row_share >= 1:
        return np.ones(len(number))
    if len(number) > 1 << 15:  # slices that fit a cache
        return np.concatenate([bag(number[at:at + (1 << 15)], spec, tree) for at in range(0, len(number), 1 << 15)])
    u = uniform(number, spec.seed, tree // spec.bag_every)
    if spec.forest:
        times = np.zeros(len(u), np.int8)
        for cut in poisson_cuts(spec.row_share):
            times += u >= cut
        return times.astype(float)
    return (u < spec.row_share).astype(float)


def derivatives(rows: Rows, margin: np.ndarray | None, spec: Spec, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if spec.forest:
        g, h = -rows.y * weight, weight
    else:
        p = 1 / (1 + np.exp(-margin))
        g, h = (p - rows.y) * weight, p * (1 - p) * weight
    return np.rint(g * UNIT), np.rint(h * UNIT)


@dataclass(frozen=True)
class Ask:
    """What a pass needs of a growing tree: its splits so far, and the nodes that are searched, each in its own features."""
    number: int
    feature: np.ndarray
    bin: np.ndarray
    kids: np.ndarray  # left and right child by turns; a leaf's are itself
    steps: int
    wanted: np.ndarray
    columns: np.ndarray  # wanted nodes x features

    def cells(self, widths: np.ndarray) -> np.ndarray:
        """Which bins there are: wanted nodes x features x the most bins, two at least."""
        return np.arange(max(widths.max(), 2)) < widths[self.columns][..., None]

    def place(self, bins: np.ndarray) -> np.ndarray:
        """The wanted node of each row, by its place in `wanted`; -1: in none."""
        node = np.zeros(len(bins), np.int64)
        flat, start = bins.ravel(), np.arange(len(bins)) * bins.shape[1]
        for _ in range(self.steps):
            node = self.kids.take(2 * node + (flat.take(start + self.feature.take(node)) > self.bin.take(node)))
        slots = np.full(len(self.feature), -1)
        slots[self.wanted] = np.arange(len(self.wanted))
        return slots[node]


def histogram(rows: Rows, margin: np.ndarray | None, spec: Spec, held: int, ask: Ask, widths: np.ndarray) -> np.ndarray:
    """Sums (g, h, rows) x cells of the wanted nodes; rows of the held-out fold are not seen."""
    seen = bag(rows.number, spec, ask.number) * (rows.fold != held)
    at = np.flatnonzero(seen)
    slot = ask.place(rows.bins[at])
    at, slot = at[slot >= 0], slot[slot >= 0]
    part = Rows(rows.bins[at], rows.y[at], rows.w[at], rows.number[at], rows.fold[at])
    sums = (*derivatives(part, None if margin is None else margin[at], spec, part.w * seen[at]), seen[at])
    cells = ask.cells(widths)
    n_nodes, n_columns, width = cells.shape
    out = np.zeros((3, *cells.shape))
    flat, start, first = part.bins.ravel(), np.arange(len(at)) * part.bins.shape[1], slot * width
    for j in range(n_columns):
        cell = first + flat.take(start + ask.columns[:, j].take(slot))
        for i, v in enumerate(sums):
            out[i, :, j] = np.bincount(cell, v, n_nodes * width).reshape(n_nodes, width)
    return out[:, cells]


def search(sums: np.ndarray, ask: Ask, widths: np.ndarray, spec: Spec) -> np.ndarray:
    """Per wanted node (gain, feature, bin, sums of the rows that go left, sums of all rows)."""
    cells = ask.cells(widths)
    hists = np.zeros((3, *cells.shape))
    hists[:, cells] = sums
    return searched(hists, ask, spec)


def searched(hists: np.ndarray, ask: Ask, spec: Spec) -> np.ndarray:
    """`search` on sums (g, h, rows) x nodes x features x bins."""
    out = np.zeros((hists.shape[1], 9))
    for i, (gain, f, b) in enumerate(best_splits(hists.transpose(1, 0, 2, 3), spec)):
        out[i] = gain, ask.columns[i, f] if f >= 0 else -1, b, *hists[:, i, f, :b + 1].sum(axis=1), *hists[:, i, 0].sum(axis=1)
    return out


# ---- one tree

@dataclass
class Tree:
    """A tree while it grows. Nodes are numbered as they are made."""
    spec: Spec
    number: int
    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    depth: list[int] = field(default_factory=lambda: [0])
    sums: list[np.ndarray | None] = field(default_factory=lambda: [None])
    best: dict[int, tuple[float, int, int]] = field(default_factory=lambda: {0: (0.0, -1, 0)})
    inside: dict[int, np.ndarray] = field(default_factory=dict)  # sums of the rows that the best split sends left
    wanted: list[int] = field(default_factory=lambda: [0])

    def ask(self, n_features: int) -> Ask:
        inner = np.array(self.left) >= 0
        own = np.arange(len(inner))
        kids = np.stack([np.where(inner, c, own) for c in (self.left, self.right)], axis=1).ravel().astype(np.int32)
        columns = self._columns(self.wanted, n_features)
        if columns is None:
            columns = np.broadcast_to(np.arange(n_features), (len(self.wanted), n_features))
        return Ask(self.number, np.where(inner, self.feature, 0).astype(np.int16), np.array(self.bin, np.int16), kids, max(self.depth),
                   np.array(self.wanted, np.int32), columns.astype(np.int16))

    def feed(self, found: np.ndarray) -> None:
        """Take what `search` found for the nodes in `wanted`."""
        if self.wanted == [0]:
            self.sums[0] = found[0, 6:]
        for n, (gain, f, b, *sums) in zip(self.wanted, found):
            if self._splittable(n):
                self.best[n] = (float(gain), int(f), int(b))
                self.inside[n] = np.array(sums[:3])

    def _splittable(self, n: int) -> bool:
        return self.sums[n][2] >= 2 * max(self.spec.min_rows, 1) and (self.spec.depth is None or self.depth[n] < self.spec.depth)

    def _columns(self, nodes: list[int], n: int) -> np.ndarray | None:
        """nodes x features: what each node may split on, drawn by hashes; None: all."""
        spec = self.spec
        pool = np.arange(n) if spec.allowed is None else np.array(spec.allowed)
        k = (int(spec.columns) or max(1, int(np.sqrt(len(pool))))) if spec.forest else max(1, int(spec.columns * len(pool)))
        if k >= n:
            return None
        draw = np.array(nodes if spec.forest else [0] * len(nodes), np.uint64)
        keys = mixed(mixed(np.uint64(spec.seed << 32 | self.number) + draw)[:, None] + pool.astype(np.uint64))
        return np.sort(pool[np.argsort(keys, axis=1, kind="stable")[:, :k]], axis=1)

    def _may_split(self, n: int) -> bool:
        return self.best[n][0] > 0 and (self.spec.depth is None or self.depth[n] < self.spec.depth)

    def chosen(self) -> tuple[list[int], list[int]]:
        """(nodes that are split, those among them whose children are not known yet) by what is known."""
        if self.spec.leaves is None:
            split = [n for n in self.best if self._may_split(n)]
            return split, [n for n in split if self.left[n] < 0]
        split, open_, heap = [], [], [(-self.best[0][0], 0)] if self._may_split(0) else []
        while heap and len(split) + 1 < self.spec.leaves:
            _, n = heapq.heappop(heap)
            split.append(n)
            if self.left[n] < 0:
                open_.append(n)
                continue
            for c in (self.left[n], self.right[n]):
                if self._may_split(c):
                    heapq.heappush(heap, (-self.best[c][0], c))
        return split, open_

    def advance(self) -> bool:
        """Make the children that are needed next; False when the tree is complete."""
        smaller, larger = [], []
        for n in self.chosen()[1]:
            _, f, b = self.best[n]
            inside = self.inside.pop(n)
            kids = len(self.left), len(self.left) + 1
            self.feature[n], self.bin[n] = f, b
            self.left[n], self.right[n] = kids
            for k, s in zip(kids, (inside, self.sums[n] - inside)):
                for column, v in ((self.feature, -1), (self.bin, 0), (self.left, -1), (self.right, -1), (self.depth, self.depth[n] + 1)):
                    column.append(v)
                self.sums.append(s)
            small, other = kids if inside[2] <= self.sums[n][2] - inside[2] else kids[::-1]
            smaller.append(small)
            larger.append(other)
        # the order decides how children are numbered, and so what columns a forest draws for them
        self.best.update((n, (0.0, -1, 0)) for n in smaller + larger)
        self.wanted = [n for n in smaller + larger if self._splittable(n)]
        return bool(self.wanted)

    def done(self) -> dict[str, np.ndarray]:
        """The tree's nodes, root first; children that the leaf budget left out are gone."""
        split = set(self.chosen()[0])
        order, at = [0], 0
        while at < len(order):
            n = order[at]
            at += 1
            if n in split:
                order += [self.left[n], self.right[n]]
        place = {n: i for i, n in enumerate(order)}
        spec = self.spec
        inner = [n in split for n in order]
        sums = np.array([self.sums[n] for n in order]) / np.array([UNIT, UNIT, 1.0])
        value = -shrunk(sums[:, 0], spec.l1) / np.maximum(sums[:, 1] + spec.l2, 1e-12) * (1.0 if spec.forest else spec.eta)
        pick = lambda column: np.array([column[n] if i else -1 for n, i in zip(order, inner)])
        return {"feature": pick(self.feature), "bin": pick(self.bin), "value": value, "cover": sums[:, 1], "rows": sums[:, 2],
                "left": np.array([place[self.left[n]] if i else -1 for n, i in zip(order, inner)]),
                "right": np.array([place[self.right[n]] if i else -1 for n, i in zip(order, inner)]),
                "gain": np.array([self.best[n][0] if i else 0.0 for n, i in zip(order, inner)])}


def shrunk(g: np.ndarray, l1: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0) if l1 else g


def best_splits(hists: np.ndarray, spec: Spec) -> list[tuple[float, int, int]]:
    """(gain, feature, bin) per node; rows up to the bin go left; the first best by feature and bin."""
    left = np.cumsum(hists, axis=3)[..., :-1]
    total = hists.sum(axis=3)[..., None]
    right = total - left

    def worth(s: np.ndarray) -> np.ndarray:
        g, h, n = s[:, 0] / UNIT, s[:, 1] / UNIT, s[:, 2]
        below = h + spec.l2 if spec.second_order or spec.forest else n
        return np.divide(shrunk(g, spec.l1) ** 2, below, out=np.zeros_like(g), where=below > 0)

    gain = (worth(left) + worth(right) - worth(total)) / 2 - spec.gamma
    ok = (left[:, 2] >= max(spec.min_rows, 1)) & (right[:, 2] >= max(spec.min_rows, 1))
    ok &= (left[:, 1] >= spec.min_weight * UNIT) & (right[:, 1] >= spec.min_weight * UNIT)
    flat = np.where(ok, gain, -np.inf).reshape(len(gain), -1)
    at = flat.argmax(axis=1)
    best = flat[np.arange(len(flat)), at]
    return [(float(v), int(i // gain.shape[2]), int(i % gain.shape[2])) if v > 1e-9 else (0.0, -1, 0) for v, i in zip(best, at)]


def depths(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Depth of every node; parents come before their children."""
    out = np.zeros(len(left), np.int64)
    for n in np.flatnonzero(left >= 0):
        out[left[n]] = out[right[n]] = out[n] + 1
    return out


def above(left: np.ndarray, right: np.ndarray, depth: int) -> np.ndarray:
    """The node at a depth that leads to each node; itself if it is not deeper."""
    level, out = depths(left, right), np.arange(len(left))
    for n in np.flatnonzero(left >= 0):
        if level[n] >= depth:
            out[left[n]] = out[right[n]] = out[n]
    return out


def walk(bins: np.ndarray, feature: np.ndarray, cut: np.ndarray, left: np.ndarray, right: np.ndarray, depth: int | None = None) -> np.ndarray:
    """The leaf of each row, or its node at a depth."""
    return steps_of(feature, cut, left, right)(bins, depth)


def steps_of(feature: np.ndarray, cut: np.ndarray, left: np.ndarray, right: np.ndarray):
    """`walk` through one tree: all rows take each step, a leaf leads to itself."""
    steps = int(depths(left, right).max())
    own = np.arange(len(left))
    kids = np.stack([np.where(left >= 0, left, own), np.where(left >= 0, right, own)], axis=1).ravel()
    feature = np.maximum(feature, 0)

    def run(bins: np.ndarray, depth: int | None = None) -> np.ndarray:
        node, flat, start = np.zeros(len(bins), np.int64), bins.ravel(), np.arange(len(bins)) * bins.shape[1]
        for _ in range(steps if depth is None else min(depth, steps)):
            node = kids.take(2 * node + (flat.take(start + feature.take(node)) > cut.take(node)))
        return node

    return run


# ---- groups of features that are counted together

class Groups:
    """Features side by side: a group's bins are one number below GROUP, or the bins of one feature that has more."""

    def __init__(self, widths: np.ndarray, features: Sequence[int] | None = None):
        self.widths = widths
        self.groups: list[list[int]] = []
        sizes: list[int] = []
        for f in sorted(range(len(widths)) if features is None else features, key=lambda f: (-widths[f], f)):
            k = next((k for k, n in enumerate(sizes) if n * widths[f] <= GROUP), len(sizes))
            if k == len(sizes):
                self.groups.append([])
                sizes.append(1)
            self.groups[k].append(int(f))
            sizes[k] *= int(widths[f])
        self.size, self.width = max(sizes), max(int(widths.max()), 2)
        self.place: dict[int, tuple[int, np.ndarray]] = {}  # feature to its group and its bin in every cell
        self.sums, self.columns = [], []
        for k, group in enumerate(self.groups):
            cell, step = np.arange(self.size), 1
            for f in group:
                self.place[f] = k, cell // step % int(widths[f])
                step *= int(widths[f])
            # cells x bins of the group's features: adds up the cells of a bin
            parts = [self.place[f][1][:, None] == np.arange(int(widths[f])) for f in group]
            self.sums.append(np.concatenate(parts, axis=1).astype(float))
            self.columns.append(np.concatenate([f * self.width + np.arange(int(widths[f])) for f in group]))

    def codes(self, bins: np.ndarray) -> np.ndarray:
        """rows x groups, and zeros up to a multiple of four."""
        out = np.zeros((len(bins), -(-len(self.groups) // 4) * 4), np.uint16)
        for k, group in enumerate(self.groups):
            step = 1
            for f in group:
                out[:, k] += bins[:, f] * np.uint16(step)
                step *= int(self.widths[f])
        return out

    def features(self, cells: np.ndarray) -> np.ndarray:
        """Sums of the features' bins from those of the groups' cells [sum, node, group, cell]."""
        out = np.zeros((*cells.shape[:2], len(self.widths) * self.width))
        for k, (sums, columns) in enumerate(zip(self.sums, self.columns)):
            out[..., columns] = cells[:, :, k] @ sums  # whole numbers: exact in any order
        return out.reshape(*cells.shape[:2], len(self.widths), self.width)


class Leaves:
    """Finds the leaf of rows given as group codes: each code rules leaves out, one is left."""

    def __init__(self, tree: dict[str, np.ndarray], groups: Groups):
        left, right, feature, cut = tree["left"], tree["right"], tree["feature"], tree["bin"]
        lo = np.zeros((len(left), len(groups.widths)), np.int16)
        hi = np.full_like(lo, np.iinfo(np.int16).max)
        for n in np.flatnonzero(left >= 0):
            a, b, f, c = left[n], right[n], feature[n], cut[n]
            lo[a], hi[a], lo[b], hi[b] = lo[n], hi[n], lo[n], hi[n]
            hi[a, f], lo[b, f] = min(hi[n, f], c), max(lo[n, f], c + 1)
        self.leaves = np.flatnonzero(left < 0)
        words = -(-len(self.leaves) // 64)
        self.tables = []
        for f in np.unique(feature[left >= 0]).tolist():
            k, bins = groups.place[f]
            keep = (bins[:, None] >= lo[self.leaves, f]) & (bins[:, None] <= hi[self.leaves, f])
            padded = np.zeros((len(bins), words * 64), bool)
            padded[:, :len(self.leaves)] = keep
            self.tables.append((k, np.ascontiguousarray(np.packbits(padded, axis=1, bitorder="little").view(np.uint64).T)))
        merged: dict[int, np.ndarray] = {}
        for k, t in self.tables:
            merged[k] = merged[k] & t if k in merged else t
        self.tables, self.words = list(merged.items()), words

    def nodes(self, codes: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
        """(rows, their nodes), in slices that fit a cache."""
        for at in range(0, len(codes), 1 << 15):
            some = codes[at:at + (1 << 15)]
            found = np.zeros(len(some), np.int64)
            if self.tables:
                for w in range(self.words):
                    left = None
                    for k, t in self.tables:
                        got = t[w].take(some[:, k])
                        left = got if left is None else np.bitwise_and(left, got, out=left)
                    # one bit is set, if any: the exponent of its number
                    number = np.full(1088, 0)
                    number[1023:1023 + len(self.leaves[64 * w:64 * w + 64])] = self.leaves[64 * w:64 * w + 64]
                    found += number.take(left.astype(float).view(np.int64) >> 52)
            yield slice(at, at + len(some)), found


# ---- models

@dataclass
class TreeModel:
    """Grown trees with the edges of the bins: a value up to edge b of a feature falls in bin b."""
    spec: Spec
    edges: list[np.ndarray]
    trees: list[dict[str, np.ndarray]]
    base: float = 0.0

    def binned(self, x: np.ndarray) -> np.ndarray:
        return to_bins(x, self.edges)

    def leaf_values(self, bins: np.ndarray) -> np.ndarray:
        """trees x rows."""
        walks, values = self._prepared({None})
        return np.stack([v.take(w(bins)) for w, v in zip(walks, values[None])])

    def predict(self, bins: np.ndarray, trees: int | None = None, depth: int | None = None) -> np.ndarray:
        """Class probability (boosted), or mean of the trees (forest); of the first trees, or cut at a depth, if asked.

        Trees that grow level by level and are cut at a depth are those that a fit with that depth gives.
        """
        return self.predictions(bins, [(trees, depth)])[0]

    def predictions(self, bins: np.ndarray, cuts: Sequence[tuple[int | None, int | None]]) -> list[np.ndarray]:
        """`predict` for several (first trees, depth): each row walks each tree once."""
        walks, values = self._prepared({depth for _, depth in cuts})
        ends = {c: min(len(self.trees) if c[0] is None else c[0], len(self.trees)) for c in cuts}
        out: dict = {}
        sums = {depth: np.zeros(len(bins)) for _, depth in cuts}
        for k in range(max(ends.values(), default=0) + 1):
            out.update((c, sums[c[1]].copy()) for c, n in ends.items() if n == k)
            if len(out) == len(ends):
                break
            node = walks[k](bins)
            for depth, total in sums.items():
                total += values[depth][k].take(node)
        if self.spec.forest:
            return [out[c] / max(ends[c], 1) for c in cuts]
        return [1 / (1 + np.exp(-(self.base + out[c]))) for c in cuts]

    def _prepared(self, cuts: set) -> tuple[list, dict]:
        """Each tree's walk and its nodes' values when it is cut at a depth; made once for all batches of a task."""
        if getattr(self, "_of", None) is not self.trees:
            self._of, self._values = self.trees, {}
            self._walks = [steps_of(t["feature"], t["bin"], t["left"], t["right"]) for t in self.trees]
        for d in cuts - set(self._values):
            self._values[d] = [t["value"] if d is None else t["value"].take(above(t["left"], t["right"], d)) for t in self.trees]
        return self._walks, self._values

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def first(self, rounds: int) -> "TreeModel":
        return replace(self, trees=self.trees[:rounds])

    def score(self, df: DataFrame, name: str = "prob", features: str = "features") -> DataFrame:
        return df.withColumn(name, scorer(self)(vector_to_array(features)))

    def nodes(self, spark: SparkSession, names: Sequence[str]) -> DataFrame:
        """One row per node: (tree, node, left, right, feature, threshold, gain, cover, rows, value)."""
        out = []
        for k, t in enumerate(self.trees):
            for n in range(len(t["left"])):
                inner = t["left"][n] >= 0
                f = int(t["feature"][n])
                out.append((k, n, int(t["left"][n]), int(t["right"][n]), names[f] if inner else None,
                            float(self.edges[f][t["bin"][n]]) if inner else None, float(t["gain"][n]), float(t["cover"][n]),
                            float(t["rows"][n]), float(t["value"][n])))
        return spark.createDataFrame(out, "tree int, node int, left int, right int, feature string, threshold double, gain double, "
                                          "cover double, rows double, value double")


def scorer(model: TreeModel):
    @F.pandas_udf("double")
    def run(x: pd.Series) -> pd.Series:
        return pd.Series(model.predict(model.binned(np.stack(x.to_numpy()))) if len(x) else [])

    return run


def to_bins(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, i], "left") for i, e in enumerate(edges)], axis=1).astype(np.uint8)


# ---- the table that all fits share

@dataclass(frozen=True)
class Binned:
    rows: DataFrame  # key, x (features), bins, y, w, number, fold
    key: str
    edges: list[np.ndarray]
    n_rows: int

    @property
    def widths(self) -> np.ndarray:
        """Bins of each feature."""
        return np.array([len(e) + 1 for e in self.edges])


def quantile_edges(x: DataFrame, size: int, bins: int) -> list[np.ndarray]:
    """Upper edges of the bins, the largest value left out; a feature with few values has one bin for each."""
    shares = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    at = lambda i: F.get("x", F.lit(i))
    row = x.agg(*[F.percentile_approx(at(i), shares, 10_000).alias(f"q{i}") for i in range(size)],
                *[F.max(at(i)).alias(f"m{i}") for i in range(size)],
                *[F.approx_count_distinct(at(i)).alias(f"n{i}") for i in range(size)]).first()
    few = [i for i in range(size) if row[f"n{i}"] <= 0.8 * bins]  # the estimate is some 5 % off
    sets = x.agg(*[F.collect_set(at(i)).alias(f"q{i}") for i in few]).first() if few else {}
    values = [(sets if i in few else row)[f"q{i}"] or [] for i in range(size)]
    return [np.array(sorted({v for v in values[i] if v < row[f"m{i}"]}), float) for i in range(size)]


def bin_rows(df: DataFrame, key: str, bins: int = 64, label: str = "label", weight: str | None = None, fold: str | None = None) -> Binned:
    """Bin the `features` vectors once. Rows without fold are in fold -1, which nothing holds out."""
    x = df.select(
        F.col(key).alias("key"), vector_to_array("features").alias("x"), F.col(label).cast("double").alias("y"),
        (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w"), (F.col(fold).cast("int") if fold else F.lit(-1)).alias("fold"),
        (F.conv(F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, 8), 16, 10).cast("bigint") % PRIME).alias("number"))
    # few bytes and much work a row: one part for each core
    x = keep(x.repartition(df.sparkSession.sparkContext.defaultParallelism, "key"))
    first = x.first()
    edges = quantile_edges(x, len(first.x), bins) if first else []

    @F.pandas_udf("binary")
    def cut(values: pd.Series) -> pd.Series:
        return pd.Series([r.tobytes() for r in to_bins(np.stack(values.to_numpy()), edges)] if len(values) else [], dtype=object)

    rows = keep(x.withColumn("bins", cut("x")) if first else x.withColumn("bins", F.lit(b"")))
    return Binned(rows, key, edges, rows.count())


def joined(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Bytes of all values, one after the other."""
    parts = []
    for c in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        ends = np.frombuffer(c.buffers()[1], np.int64 if pa.types.is_large_binary(c.type) else np.int32)[c.offset:c.offset + len(c) + 1] if len(c) else [0, 0]
        parts.append(np.frombuffer(c.buffers()[2], np.uint8)[ends[0]:ends[-1]] if ends[-1] > ends[0] else np.zeros(0, np.uint8))
    return parts[0] if len(parts) == 1 else np.concatenate(parts or [np.zeros(0, np.uint8)])


def rows_of(table: pa.Table | pa.RecordBatch, n_features: int) -> Rows:
    col = lambda n: table.column(n).to_numpy() if isinstance(table, pa.Table) else table.column(
        table.schema.get_field_index(n)).to_numpy(zero_copy_only=False)
    bins = joined(table.column(table.schema.get_field_index("bins"))).reshape(-1, n_features)
    return Rows(bins, *(np.asarray(col(n), float if n in "yw" else np.int64) for n in ("y", "w", "number", "fold")))


@dataclass(frozen=True)
class Job:
    spec: Spec
    held: int = -2  # the fold whose rows it does not see


def prior(pos: float, n: float) -> float:
    p = min(max(pos / n, 1e-6), 1 - 1e-6) if n else 0.5
    return float(np.log(p / (1 - p)))


class Counter:
    """Rows of a tree, dealt to its nodes as blocks of records, and the sums over the bins of nodes that may split.

    A record holds a row's group codes and one or two numbers for (g, h, rows): h is kept in the lower part of a number whose upper
    part counts rows, where the sums of COUNTED rows fit 53 bits; a forest on rows of weight 1 needs no h, and with labels 0 and 1 one number in all.
    """

    def __init__(self, groups: Groups, codes: np.ndarray, g: np.ndarray, h: np.ndarray, n: np.ndarray, forest: bool):
        self.groups = groups
        self.even = forest and bool((h == n * UNIT).all())
        self.plain = self.even and bool(((g == 0) | (g == -h)).all())
        most = int((n if self.plain else h).max(initial=0)) * COUNTED
        self.unit = float(1 << most.bit_length())
        self.packed = self.plain or not self.even and int(n.max(initial=0)) * COUNTED * self.unit < 1 << 52
        sums = [n - g * (self.unit / UNIT)] if self.plain else [g, n] if self.even else [g, h + n * self.unit] if self.packed else [g, h, n]
        self.width = codes.shape[1] // 4  # codes take so many times 8 bytes
        block = np.empty((len(g), self.width + len(sums)))
        block.view(np.uint16)[:, :codes.shape[1]] = codes
        for i, v in enumerate(sums):
            block[:, self.width + i] = v
        self.blocks: dict[int, np.ndarray] = {0: block}
        self.hists: dict[int, np.ndarray] = {}

    def unpacked(self, sums: np.ndarray) -> list[np.ndarray]:
        if not self.packed:
            return [sums[0], sums[1] * UNIT, sums[1]] if self.even else list(sums)
        upper = np.floor(sums[-1] / self.unit)
        lower = sums[-1] - upper * self.unit
        return [upper * -UNIT, lower * UNIT, lower] if self.plain else [sums[0], lower, upper]

    def count(self, nodes: Sequence[int]) -> np.ndarray:
        """Sums (g, h, rows) of the nodes x features x bins."""
        n_groups, size = len(self.groups.groups), self.groups.size
        n_sums = self.blocks[nodes[0]].shape[1] - self.width
        part = np.zeros((n_sums, n_groups, len(nodes), size))
        out = np.zeros((3, n_groups, len(nodes), size))

        def add(pieces: list) -> None:
            block = pieces[0][1] if len(pieces) == 1 else np.concatenate([p for _, p in pieces])
            first, k = pieces[0][0], pieces[-1][0] - pieces[0][0] + 1
            start = np.repeat(np.array([i - first for i, _ in pieces]) * size, [len(p) for _, p in pieces]) if k > 1 else None
            sums = [np.ascontiguousarray(block[:, self.width + i]) for i in range(n_sums)]
            codes = block.view(np.uint16)
            for j in range(n_groups):
                cell = codes[:, j].astype(np.intp)
                if start is not None:
                    cell += start
                for i, v in enumerate(sums):
                    part[i, j, first:first + k] += np.bincount(cell, v, k * size).reshape(k, size)

        waiting, held, open_ = [], 0, COUNTED // 4
        for i, node in enumerate(nodes):
            block, since = self.blocks[node], 0
            for at in range(0, len(block), open_):
                piece = block[at:at + open_]
                if held + len(piece) > open_:
                    add(waiting)
                    waiting, held = [], 0
                if since + len(piece) > COUNTED:  # what is counted of this node fills its numbers
                    for v, got in zip(out, self.unpacked(part[:, :, i])):
                        v[:, i] += got
                    part[:, :, i], since = 0, 0
                waiting.append((i, piece))
                held += len(piece)
                since += len(piece)
        if waiting:
            add(waiting)
        for v, got in zip(out, self.unpacked(part)):
            v += got
        return self.groups.features(out.transpose(0, 2, 1, 3))

    def wanted(self, tree: Tree, families: dict[int, tuple[int, int]]) -> np.ndarray:
        """Sums of the tree's wanted nodes; of two children the smaller is counted, the other is the rest of their parent."""
        if tree.wanted == [0]:
            self.hists[0] = self.count([0])[:, 0]
        else:
            want = set(tree.wanted)
            pairs = [(p, *sorted(kids, key=lambda c: (tree.sums[c][2], c))) for p, kids in families.items() if want & set(kids)]
            for (p, small, large), hist in zip(pairs, self.count([small for _, small, _ in pairs]).transpose(1, 0, 2, 3)):
                whole = self.hists.pop(p)
                if small in want:
                    self.hists[small] = hist
                if large in want:
                    self.hists[large] = whole - hist
        return np.stack([self.hists[n] for n in tree.wanted], axis=1)

    def deal(self, tree: Tree, families: dict[int, tuple[int, int]]) -> None:
        """Rows of the split nodes go to their children."""
        want = set(tree.wanted)
        for p, (a, b) in families.items():
            block = self.blocks.pop(p)
            if not want & {a, b}:
                self.hists.pop(p, None)
                continue
            k, bins = self.groups.place[tree.feature[p]]
            inside = (bins <= tree.bin[p]).take(block.view(np.uint16)[:, k])
            self.blocks[a], self.blocks[b] = (block.take(np.flatnonzero(m), axis=0) for m in (inside, ~inside))


def grow_tree(tree: Tree, counter: Counter) -> dict[str, np.ndarray]:
    """Grow to the end on rows in memory."""
    n_features, families = len(counter.groups.widths), {}
    while True:
        ask = tree.ask(n_features)
        if families:
            counter.deal(tree, families)
        hists = counter.wanted(tree, families)
        tree.feed(searched(hists[:, np.arange(len(ask.columns))[:, None], ask.columns], ask, tree.spec))
        if not tree.advance():
            return tree.done()
        families = {p: (tree.left[p], tree.right[p]) for p in counter.blocks if tree.left[p] >= 0}


def grow_all(rows: Rows, job: Job, widths: np.ndarray, trees: range) -> tuple[float, list[dict[str, np.ndarray]]]:
    """The trees of a job; `rows` are those that its fold leaves in."""
    spec, out = job.spec, []
    groups = Groups(widths, spec.allowed)
    base = prior(float((rows.y * rows.w).sum()), float(rows.w.sum())) if spec.from_mean and not spec.forest else 0.0
    margin = None if spec.forest else np.full(len(rows.y), base)
    masked = len(rows.y) >= MASKED
    codes, drawn = groups.codes(rows.bins), -1
    if masked:
        rows.bins = None  # the codes say the same
    for t in trees:
        if drawn != t // spec.bag_every:
            drawn, times = t // spec.bag_every, bag(rows.number, spec, t)
            seen = np.flatnonzero(times) if (times == 0).any() else None
            pick = lambda v: v if seen is None else v.take(seen, axis=0)
            mine, times, part = pick(codes), pick(times), Rows(None, pick(rows.y), pick(rows.w), None, None)
            part.w = part.w * times
        g, h = derivatives(part, None if margin is None else pick(margin), spec, part.w)
        done = grow_tree(Tree(spec, t), Counter(groups, mine, g, h, times, spec.forest))
        if margin is not None:
            if masked:
                for at, node in Leaves(done, groups).nodes(codes):
                    margin[at] += done["value"].take(node)
            else:
                margin = margin + done["value"][walk(rows.bins, done["feature"], done["bin"], done["left"], done["right"])]
        out.append(done)
    return base, out


NODE_SCHEMA = ("job int, tree int, base double, feature array<int>, bin array<int>, left array<int>, right array<int>, value array<double>, "
               "cover array<double>, rows array<double>, gain array<double>")
_PARTS = ("feature", "bin", "left", "right", "value", "cover", "rows", "gain")
_KINDS = ("i2", "i2", "i4", "i4", "f8", "f8", "f8", "f8")


def compact(v: np.ndarray) -> np.ndarray:
    """The same numbers in bytes where they are whole and small."""
    small = v.astype(np.uint8) if len(v) and v.min() >= 0 and v.max() <= 255 else v
    return small if (small == v).all() else v


def dealt(spark: SparkSession, n: int) -> list[int]:
    """For each of n partitions a number that is dealt to it, so that a task gets one fit."""
    found = spark.range(64 * n).select("id", F.pmod(F.hash("id"), F.lit(n)).alias("part")).toArrow()
    first: dict[int, int] = {}
    for i, p in zip(found.column("id").to_pylist(), found.column("part").to_pylist()):
        first.setdefault(p, i)
    spare = iter(range(64 * n, 65 * n))
    return [first[p] if p in first else next(spare) for p in range(n)]


def local_tasks(jobs: Sequence[Job], trees_per_task: int) -> list[tuple[int, range]]:
    """(job, trees) of each task, the longest first; trees of a booster wait for each other."""
    tasks = []
    for j, job in enumerate(jobs):
        step = trees_per_task if job.spec.forest else job.spec.rounds
        tasks += [(j, range(a, min(a + step, job.spec.rounds))) for a in range(0, job.spec.rounds, step)]
    return sorted(tasks, key=lambda t: -len(t[1]) * (jobs[t[0]].spec.depth or 8))


def forest_share(data: Binned, jobs: Sequence[Job]) -> int:
    """Trees of a forest that a task grows: some tasks for each core, since each is sent the rows."""
    cores = data.rows.sparkSession.sparkContext.defaultParallelism
    return max(25, -(-sum(j.spec.rounds for j in jobs if j.spec.forest) // (4 * cores)))


def fit_local(data: Binned, jobs: Sequence[Job], trees_per_task: int | None = None) -> list[TreeModel]:
    """Each fit is a task that holds all rows; trees of a forest are dealt to several.

    Rows are packed to blocks of bytes, a copy for each task; a task reads block after block.
    """
    tasks = local_tasks(jobs, trees_per_task or forest_share(data, jobs))
    n_features, widths, spark = len(data.edges), data.widths, data.rows.sparkSession
    salts = dealt(spark, len(tasks))
    of = {s: t for s, t in zip(salts, tasks)}

    def pack(batches):
        for b in batches:
            if b.num_rows:
                r = rows_of(b, n_features)
                block = pickle.dumps((r.bins, compact(r.y), compact(r.w), r.number.astype(np.int32), r.fold.astype(np.int32)), 5)
                yield pa.RecordBatch.from_arrays([pa.array([block])], ["block"])

    def run(it):
        got: dict[int, list] = {}
        for r in it:
            bins, y, w, number, fold = pickle.loads(r.block)
            seen = fold != jobs[of[r.salt][0]].held
            got.setdefault(r.salt, []).append((bins[seen], y[seen], w[seen], number[seen]))
        for salt in list(got):
            j, trees = of[salt]
            bins, y, w, number = (np.concatenate(c) for c in zip(*got.pop(salt)))
            base, grown = grow_all(Rows(bins, y.astype(float), w.astype(float), number, None), jobs[j], widths, trees)
            for t, tree in zip(trees, grown):
                yield j, t, base, bytearray(pickle.dumps([tree[p].astype(k) for p, k in zip(_PARTS, _KINDS)], 5))

    # exact sums make the order of rows irrelevant
    blocks = data.rows.select("bins", "y", "w", "number", "fold").mapInArrow(pack, "block binary")
    spread = blocks.select("block", F.explode(F.array(*[F.lit(s).cast("bigint") for s in salts])).alias("salt"))
    grown = spread.repartition(len(tasks), "salt").rdd.mapPartitions(run)
    found = spark.createDataFrame(grown, "job int, tree int, base double, nodes binary").toArrow()
    models = [TreeModel(job.spec, data.edges, []) for job in jobs]
    order = sorted(range(found.num_rows), key=list(zip(found.column("job").to_pylist(), found.column("tree").to_pylist())).__getitem__)
    for i in order:
        m = models[found.column("job")[i].as_py()]
        m.base = found.column("base")[i].as_py()
        m.trees.append({p: v.astype(np.int64 if k != "f8" else float) for p, k, v in zip(_PARTS, _KINDS, pickle.loads(found.column("nodes")[i].as_py()))})
    return models


def part_size(data: Binned, most: int, least: int = 1 << 12) -> int:
    """Rows of a partition: one for each core, so that the sums that are shuffled do not grow with the rows; `most` bounds its memory."""
    cores = data.rows.sparkSession.sparkContext.defaultParallelism
    return min(max(-(-data.n_rows // cores), least), most)


def added(pairs: RDD, parts: int) -> RDD:
    """(key, sum of its arrays); keys are whole numbers from 0. One array a key is held at a time and given on."""
    def run(it):
        sums: dict = {}
        for k, v in it:
            sums[k] = sums[k] + v if k in sums else v
        yield from sums.items()

    return pairs.partitionBy(max(1, parts)).mapPartitions(run)


def fit_spread(data: Binned, jobs: Sequence[Job], part_rows: int | None = None) -> list[TreeModel]:
    """All fits in step: a pass adds up histograms by tree and searches the splits where they are added up, in chunks of bounded size.

    Works on partitions as arrays, which data frames do not offer; each partition's margins are kept by Spark and
    written to the shared folder every 20 rounds, so a lost executor costs the rounds since.
    """
    sc = data.rows.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_dir(data.rows.sparkSession) + "/rounds")
    n_features, widths = len(data.edges), data.widths
    n_parts = max(1, -(-data.n_rows // (part_rows or part_size(data, 1 << 19))))

    def pack(batches):
        for b in batches:
            r = rows_of(b, n_features)
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()]) for x in (r.bins, r.y, r.w, r.number, r.fold)], ["b", "y", "w", "n", "f"])

    def load(it):
        got = [Rows(np.frombuffer(r.b, np.uint8).reshape(-1, n_features), *(np.frombuffer(v, t) for v, t in (
            (r.y, float), (r.w, float), (r.n, np.int64), (r.f, np.int64)))) for r in it]
        if got:
            yield Rows(*(np.concatenate([getattr(g, c) for g in got]) for c in ("bins", "y", "w", "number", "fold")))

    base_rows = data.rows.select("bins", "y", "w", "number", "fold").repartition(n_parts)
    rows = base_rows.mapInArrow(pack, "b binary, y binary, w binary, n binary, f binary").rdd.mapPartitions(load)
    counts = rows.map(lambda r: np.array([[(r.y * r.w)[r.fold != j.held].sum(), r.w[r.fold != j.held].sum()] for j in jobs]))
    total = counts.treeReduce(np.add)
    models = [TreeModel(j.spec, data.edges, [], prior(*total[k]) if j.spec.from_mean and not j.spec.forest else 0.0) for k, j in enumerate(jobs)]
    bases = [m.base for m in models]
    level = StorageLevel.MEMORY_AND_DISK
    state = rows.map(lambda r: (r, [None if j.spec.forest else np.full(len(r.y), b) for j, b in zip(jobs, bases)])).persist(level)
    before = None

    def grow(growing: list) -> list:
        nonlocal before
        open_ = growing
        while open_:
            for chunk in _chunks([(k, tree, tree.ask(n_features)) for k, tree in open_], widths):
                asked = [(k, ask) for k, _, ask in chunk]

                def sums(it, asked=asked):
                    for r, margins in it:
                        for i, (k, ask) in enumerate(asked):
                            yield i, histogram(r, margins[k], jobs[k].spec, jobs[k].held, ask, widths)

                def best(got, asked=asked):
                    k, ask = asked[got[0]]
                    return got[0], search(got[1], ask, widths, jobs[k].spec)

                found = added(state.mapPartitions(sums), min(len(asked), sc.defaultParallelism)).map(best).collect()
                for i, got in found:
                    chunk[i][1].feed(got)
                if before is not None:  # the margins of this round are there
                    before.unpersist()
                    before = None
            open_ = [g for g in open_ if g[1].advance()]
        return [(k, tree.done()) for k, tree in growing]

    # a forest's trees do not wait for each other
    forests = [(k, i) for k, j in enumerate(jobs) if j.spec.forest for i in range(j.spec.rounds)]
    for at in range(0, len(forests), GROWING):
        for k, done in grow([(k, Tree(jobs[k].spec, i)) for k, i in forests[at:at + GROWING]]):
            models[k].trees.append(done)
    rounds = {k: j.spec.rounds for k, j in enumerate(jobs) if not j.spec.forest}
    for t in range(max(rounds.values(), default=0)):
        moved = grow([(k, Tree(jobs[k].spec, t)) for k, n in rounds.items() if t < n])
        for k, done in moved:
            models[k].trees.append(done)
        before, state = state, state.map(lambda s, moved=moved: (s[0], _moved(s, moved))).persist(level)
        if t % 20 == 19:
            state.checkpoint()
    for kept in (before, state):
        if kept is not None:
            kept.unpersist()
    return models


def _moved(state: tuple, moved: list) -> list:
    rows, margins = state[0], list(state[1])
    for k, t in moved:
        margins[k] = margins[k] + t["value"][walk(rows.bins, t["feature"], t["bin"], t["left"], t["right"])]
    return margins


def _chunks(growing: list, widths: np.ndarray):
    part, size = [], 0
    for g in growing:
        n = 3 * int(widths[g[2].columns].sum())
        if part and size + n > CELLS:
            yield part
            part, size = [], 0
        part.append(g)
        size += n
    if part:
        yield part


def fit_trees(data: Binned, jobs: Sequence[Job]) -> list[TreeModel]:
    """Models in the order of the jobs. Both ways give the same trees; the number of rows decides which is run."""
    if data.n_rows == 0:
        raise ValueError("no rows to learn from")
    small = data.n_rows <= LOCAL_ROWS and data.n_rows * len(local_tasks(jobs, forest_share(data, jobs))) <= LOCAL_COPIES
    return (fit_local if small else fit_spread)(data, jobs)


def loss_by_round(model: TreeModel, df: DataFrame, label: str = "label", features: str = "features") -> DataFrame:
    """(rounds, loss): mean log loss of the rows after each boosting round, summed per batch before it is shuffled."""
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            y = b.column(1).to_numpy()
            margin = model.base + np.cumsum(model.leaf_values(model.binned(np.stack(b.column(0).to_numpy(zero_copy_only=False)))), axis=0)
            loss = np.logaddexp(0, np.where(y == 1, -margin, margin)).sum(axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(1, len(loss) + 1, dtype=np.int32)), pa.array(loss),
                                              pa.array(np.full(len(loss), b.num_rows))], ["rounds", "loss", "n"])

    x = df.select(vector_to_array(features).alias("x"), F.col(label).cast("int").alias("y"))
    return x.mapInArrow(run, "rounds int, loss double, n bigint").groupBy("rounds").agg((F.sum("loss") / F.sum("n")).alias("loss"))


def save_trees(spark: SparkSession, model: TreeModel, path: str) -> None:
    """A row per tree and one of settings, as Parquet."""
    rows = [(k, model.base, *[t[p].tolist() for p in _PARTS]) for k, t in enumerate(model.trees)]
    spark.createDataFrame(rows, NODE_SCHEMA.split(", ", 1)[1]).write.parquet(f"{path}/trees")
    settings = [(json.dumps(asdict(model.spec)), [e.tolist() for e in model.edges], model.base)]
    spark.createDataFrame(settings, "spec string, edges array<array<double>>, base double").write.parquet(f"{path}/settings")


def load_trees(spark: SparkSession, path: str) -> TreeModel:
    row = spark.read.parquet(f"{path}/settings").first()
    trees = [{p: np.array(r[p], np.int64 if p in ("feature", "bin", "left", "right") else float) for p in _PARTS}
             for r in spark.read.parquet(f"{path}/trees").orderBy("tree").collect()]
    return TreeModel(Spec(**json.loads(row.spec)), [np.array(e) for e in row.edges], trees, row.base)
