"""Single classification trees, pruned by cost complexity.

The risk of a node is the weight of its rows outside its majority class, as a share of the root's. Weakest-link pruning
gives the nested subtrees that are best for each price per split; the price is chosen by cross-validation. The full tree and those of
all folds are grown in the same passes, and one scan of the rows judges every fold's whole sequence.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensity.operators.boosting import Binned, Job, Spec, TreeModel, fit_trees, rows_of, walk

# Depth, least rows of a leaf (a split needs twice as many), least complexity.
TREE = Spec(rounds=1, depth=4, min_rows=10, forest=True, bagged=False, columns=1e9)
LEAST_COMPLEXITY = 0.01

Arrays = dict[str, np.ndarray]


def node_risk(tree: Arrays) -> np.ndarray:
    """Weight of each node's rows outside its majority class."""
    return np.minimum(tree["value"], 1 - tree["value"]) * tree["cover"]


def _below(tree: Arrays, inner: np.ndarray, risk: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(risk, number) of the leaves under each node; children have larger numbers than their parent."""
    total, leaves = risk.copy(), np.ones(len(risk), np.int64)
    for n in reversed(np.flatnonzero(inner).tolist()):
        kids = [tree["left"][n], tree["right"][n]]
        total[n], leaves[n] = total[kids].sum(), leaves[kids].sum()
    return total, leaves


def _reached(tree: Arrays, inner: np.ndarray) -> np.ndarray:
    seen = np.zeros(len(inner), bool)
    seen[0] = True
    for n in np.flatnonzero(inner).tolist():
        if seen[n]:
            seen[[tree["left"][n], tree["right"][n]]] = True
    return seen


def weakest_links(tree: Arrays) -> list[tuple[float, np.ndarray]]:
    """(price, which nodes stay split), cheapest first, the root alone last.

    A price is a share of the root's risk per split; each subtree is the smallest that is best from its price up to the next one's.
    Links that are equally weak go together.
    """
    risk = node_risk(tree)
    eps = 1e-9 * max(risk[0], 1.0)
    inner = _reached(tree, tree["left"] >= 0) & (tree["left"] >= 0)
    price, out = 0.0, []
    while True:
        total, leaves = _below(tree, inner, risk)
        nodes = np.flatnonzero(inner)
        link = (risk[nodes] - total[nodes]) / (leaves[nodes] - 1)
        weakest = link.min() if len(link) else math.inf
        if weakest > price + eps:
            out.append((float(price / risk[0]) if risk[0] > 0 else 0.0, inner.copy()))
            if not len(nodes):
                return out
            price = weakest
        inner[nodes[link <= price + eps]] = False
        inner &= _reached(tree, inner)


def subtree(tree: Arrays, inner: np.ndarray) -> Arrays:
    """The tree with only the nodes `inner` split, numbered anew, root first."""
    inner = inner & _reached(tree, inner)
    stay = np.flatnonzero(_reached(tree, inner))
    place = np.full(len(inner), -1)
    place[stay] = np.arange(len(stay))
    out = {c: v[stay].copy() for c, v in tree.items()}
    leaf = ~inner[stay]
    for c in ("left", "right"):
        out[c] = np.where(leaf, -1, place[out[c]])
    out["feature"][leaf], out["bin"][leaf], out["gain"][leaf] = -1, -1, 0.0
    return out


def pruned(model: TreeModel, price: float) -> TreeModel:
    """The model with its tree cut back to the smallest subtree that is best at a price."""
    tree = model.trees[0]
    best = [inner for p, inner in weakest_links(tree) if p <= price + 1e-12][-1]
    return replace(model, trees=[subtree(tree, best)])


@dataclass(frozen=True)
class PruningPath:
    """The sequence of subtrees with their cross-validated errors, as shares of the root's risk."""
    full: TreeModel
    rows: list[tuple]  # complexity, n_splits, rel_error, xerror, xstd; largest tree last

    @property
    def smallest(self) -> float:
        """The complexity of smallest cross-validated error; of equal ones that of the smallest tree."""
        return min(self.rows, key=lambda r: (round(r[3], 12), r[1]))[0]

    @property
    def within_one_error(self) -> float:
        """The complexity of the smallest tree whose error is within one standard error of the smallest."""
        best = min(self.rows, key=lambda r: (round(r[3], 12), r[1]))
        return min((r for r in self.rows if r[3] <= best[3] + best[4] + 1e-12), key=lambda r: r[1])[0]

    def model(self, complexity: float | None = None) -> TreeModel:
        return pruned(self.full, self.smallest if complexity is None else complexity)

    def table(self, spark: SparkSession) -> DataFrame:
        marks = (self.smallest, self.within_one_error) if self.rows else ()
        rows = [(*r, r[0] == marks[0], r[0] == marks[1]) for r in self.rows]
        return spark.createDataFrame(rows, "complexity double, n_splits int, rel_error double, xerror double, xstd double, "
                                           "is_smallest boolean, is_one_error boolean").orderBy("n_splits")


def _errors(data: Binned, variants: list[list[Arrays]]) -> dict[int, tuple[float, float, float]]:
    """Candidate to (rows, weight of wrong rows, sum of squared weights of wrong rows): each row is judged by
    the trees of its own fold, in one scan."""
    n_features = len(data.edges)

    def run(batches):
        for b in batches:
            r = rows_of(b, n_features)
            out = []
            for f, trees in enumerate(variants):
                mine = r.fold == f
                if mine.any():
                    for k, t in enumerate(trees):
                        guess = t["value"][walk(r.bins[mine], t["feature"], t["bin"], t["left"], t["right"])] >= 0.5
                        bad = r.w[mine] * (guess != (r.y[mine] >= 0.5))
                        out.append((k, float(mine.sum()), bad.sum(), (bad ** 2).sum()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["k", "n", "bad", "squares"])

    sums = (data.rows.select("bins", "y", "w", "number", "fold").mapInArrow(run, "k bigint, n double, bad double, squares double")
            .groupBy("k").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.sum("squares").alias("squares")))
    return {r.k: (r.n, r.bad, r.squares) for r in sums.collect()}


def pruning_path(data: Binned, folds: int, spec: Spec = TREE, least: float = LEAST_COMPLEXITY) -> PruningPath:
    """Subtrees of complexity `least` and more, with their errors on the rows that a fold's tree did not see.

    A fold's tree is pruned at the geometric mean of the ends of each subtree's range of prices. `data` has folds 0 to
    folds - 1. Without rows, or with one class only, the path is the root alone, and its errors are 0.
    """
    if not data.n_rows:
        return PruningPath(TreeModel(spec, data.edges, [_lone(0.0)]), [(least, 0, 0.0, 0.0, 0.0)])
    full, *held = fit_trees(data, [Job(spec)] + [Job(spec, f) for f in range(folds)])
    tree = full.trees[0]
    links = weakest_links(tree)
    ends = [p for p, _ in links[1:]] + [math.inf]
    wanted = [(max(p, least), end, inner) for (p, inner), end in zip(links, ends) if end > least]
    middles = [math.sqrt(p * end) for p, end, _ in wanted]
    bad = _errors(data, [[pruned(m, x).trees[0] for x in middles] for m in held])
    root = node_risk(tree)[0]
    rows = []
    for k, (p, _, inner) in enumerate(wanted):
        n, wrong, squares = bad.get(k, (0.0, 0.0, 0.0))
        part = subtree(tree, inner)
        rel = node_risk(part)[part["left"] < 0].sum()
        spread = math.sqrt(max(squares - (wrong ** 2 / n if n else 0.0), 0.0))
        rows.append((p, int((part["left"] >= 0).sum()), *(float(x / root) if root > 0 else 0.0 for x in (rel, wrong, spread))))
    return PruningPath(full, rows[::-1])


def _lone(value: float) -> Arrays:
    none = np.array([-1])
    return {"feature": none, "bin": none, "value": np.array([value]), "cover": np.zeros(1), "rows": np.zeros(1), "left": none,
            "right": none, "gain": np.zeros(1)}
