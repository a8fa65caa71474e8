"""Connected components of a link table, by hooking on smaller neighbours and contracting the links.

Each round every vertex with a smaller neighbour hooks on its smallest one, pointer jumping follows the hooks to
vertices that have none, and the links are renamed by these: links inside one class vanish and equal ones become one. So a round
reads what the last one left, and a group with very many links is read twice, not in every round. At least half of the vertices
are gone after two rounds. Minima are combined in the tasks before the shuffle, so a vertex with very many
links is no burden. Nothing is collected but counts of what is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.session import keep


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): for every vertex of `links` the smallest vertex it is connected with.

    Direction, repetition and loops of links do not matter; links with a null end are left out.
    """
    pairs = links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a is not null and b is not null")
    edges = keep(_ordered(pairs))
    labels = None
    while True:
        tops = _tops(edges)
        if labels is None:
            labels = tops
        else:
            further = tops.select(F.col("id").alias("component"), F.col("top").alias("further"))
            moved = labels.select("id", F.col("top").alias("component")).join(further, "component", "left").select(
                "id", F.coalesce("further", "component").alias("top"))
            # a vertex that hooks for the first time is a top of others
            labels = keep(moved.unionByName(tops.join(labels, "id", "left_anti")))
        low = tops.select(F.col("id").alias("a"), F.col("top").alias("ta"))
        high = tops.select(F.col("id").alias("b"), F.col("top").alias("tb"))  # the larger end of a link always hooks
        edges = keep(_ordered(edges.join(high, "b").join(low, "a", "left").select(F.coalesce("ta", "a").alias("a"), F.col("tb").alias("b"))))
        if not edges.limit(1).count():
            break
    # smallest vertices hook nowhere, and loops have no other vertex
    named = labels.select("id", F.col("top").alias("component"))
    others = labels.select(F.col("top").alias("id")).union(pairs.filter("a = b").select("a")).distinct().join(labels, "id", "left_anti")
    return named.unionByName(others.select("id", F.col("id").alias("component")))


def _ordered(pairs: DataFrame) -> DataFrame:
    """The pairs with different ends, each once, the smaller end first."""
    return pairs.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _tops(edges: DataFrame) -> DataFrame:
    """(id, top): for each vertex with a smaller neighbour the vertex without one that its hooks lead to."""
    hooks = keep(edges.groupBy(F.col("b").alias("id")).agg(F.min("a").alias("top")))
    while True:
        above = hooks.select(F.col("id").alias("top"), F.col("top").alias("above"))
        step = keep(hooks.join(above, "top", "left").select("id", F.coalesce("above", "top").alias("top"), F.col("above").isNotNull().alias("moved")))
        if not step.filter("moved").limit(1).count():
            return hooks
        hooks = step.select("id", "top")
