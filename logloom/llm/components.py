"""Connected components of a graph that no machine can hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.session import settle


def _jumped(parents: DataFrame) -> DataFrame:
    """Pointers (node, parent) followed to their ends."""
    while True:
        above = parents.select(F.col("node").alias("parent"), F.col("parent").alias("top"))
        parents = settle(parents.join(above, "parent").select(
            "node", F.col("top").alias("parent"), (F.col("top") != F.col("parent")).alias("moved")))
        moved = parents.where("moved").limit(1).count()
        parents = parents.drop("moved")
        if not moved:
            return parents


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node it reaches, for every end of ``links`` (a, b).

    Each round points every node at the smallest of itself and its neighbours, follows the pointers to their ends and
    replaces nodes by these; links inside a group vanish. The number of nodes with links left at least halves.
    """
    links = settle(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    rounds = []
    while not links.isEmpty():
        both = links.union(links.select(F.col("b"), F.col("a")))
        nearest = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
        parents = _jumped(settle(nearest.select("node", F.least("node", "near").alias("parent"))))
        rounds.append(parents)
        ends = links
        for end in ("a", "b"):
            ends = ends.join(parents.select(F.col("node").alias(end), F.col("parent").alias(f"new_{end}")), end)
        ends = ends.where("new_a <> new_b")
        links = settle(ends.select(F.least("new_a", "new_b").alias("a"), F.greatest("new_a", "new_b").alias("b")).distinct())
    if not rounds:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    found = rounds[0].select("node", F.col("parent").alias("component"))
    for later in rounds[1:]:
        later = later.select(F.col("node").alias("component"), F.col("parent").alias("top"))
        found = found.join(later, "component", "left").select("node", F.coalesce("top", "component").alias("component"))
    return found
