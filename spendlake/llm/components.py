"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake.llm.text import stored


def _roots(parents: DataFrame) -> DataFrame:
    """Follow (node, label) to the end: each step doubles the length of path that is jumped."""
    while True:
        up = parents.select(F.col("node").alias("label"), F.col("label").alias("next"))
        jumped = stored(
            parents.join(up, "label", "left").select(
                "node", F.coalesce("next", "label").alias("label"), (F.col("next") != F.col("label")).alias("moved")
            ),
            "labels",
        )
        parents = jumped.select("node", "label")
        if jumped.filter("moved").isEmpty():
            return parents


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of the edges (a, b), equal labels for connected nodes.

    Every node hooks onto its smallest neighbour if that is smaller, trees are
    flattened, and the graph of the trees is solved in the same way; it has at
    most half of the nodes. An edge is read once per level, a hub is one
    partial minimum per task.
    """
    labels = None
    edges = stored(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    while labels is None or not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        hooked = both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("label"))
        trees = _roots(stored(hooked, "labels"))
        if labels is None:
            labels = trees
        else:
            upper = trees.select(F.col("node").alias("label"), F.col("label").alias("root"))
            labels = stored(labels.join(upper, "label", "left").select("node", F.coalesce("root", "label").alias("label")), "labels")
        root = trees.select(F.col("node"), F.col("label"))
        a = root.select(F.col("node").alias("a"), F.col("label").alias("ra"))
        b = root.select(F.col("node").alias("b"), F.col("label").alias("rb"))
        edges = stored(
            edges.join(a, "a").join(b, "b").filter("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(),
            "edges",
        )
    return labels
