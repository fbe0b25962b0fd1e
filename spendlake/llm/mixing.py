"""Mixing sources to target weights by hierarchical budgets.

The token budget goes down a tree of level columns, from the root to the leaves.
At each node the children share it by weight; a child that holds fewer tokens
(times the allowed epochs) than its share is filled, and what it cannot take
goes to its siblings by weight. As a node never gets more than all it holds, a
shortage is shared among siblings first and only then further up. Every leaf is
then cut to its budget: whole epochs, and of one more epoch the longest prefix
in an order seeded by epoch and document that fits.

Shares are whole tokens, computed in integers. The order is drawn by md5; the
prefix is found from the sums of 4096 hash bins per leaf, so only the one bin
in which the budget ends is sorted, however large the leaf.

Main path: DataFrame functions only. Defined results: null levels count as '';
a node without a given weight has weight 1; a weight of 0 takes nothing; a null
text has no tokens; documents without tokens are in the prefix if they precede
its end; rows that repeat id and text fall on the same side of the cut; an empty
table gives no rows; further columns travel with their rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendlake.llm.text import stored, words

SEED = "mix-1"
MAX_EPOCHS = 2
# The budget as a share of all tokens.
SHARE = Fraction(4, 5)


def weight_of(level: str, weights: Mapping[str, Mapping[str, int]]) -> Column:
    """The weight of a node by its name in that level."""
    named = weights.get(level, {})
    weight = F.lit(1)
    for name, value in named.items():
        weight = F.when(F.col(level) == name, value).otherwise(weight)
    return weight.cast("long")


def _shared_out(children: DataFrame, parent: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``budget`` of every child (cap, weight, parent_budget) of its parent, by filling the poorest first."""
    every = Window.partitionBy(*parent)
    poorest = every.orderBy(F.col("cap") / F.col("weight"), *order)
    before = poorest.rowsBetween(Window.unboundedPreceding, -1)
    some = children.filter("weight > 0").select(
        "*",
        F.sum("weight").over(every).alias("all_weight"),
        F.coalesce(F.sum("cap").over(before), F.lit(0)).alias("cap_before"),
        F.coalesce(F.sum("weight").over(before), F.lit(0)).alias("weight_before"),
    )
    full = some.withColumn(
        "full", F.expr("cap * (all_weight - weight_before) <= (parent_budget - cap_before) * weight")
    ).select(
        "*",
        F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(every), F.lit(0)).alias("filled"),
        F.coalesce(F.sum(F.when(F.col("full"), F.col("weight"))).over(every), F.lit(0)).alias("filled_weight"),
    )
    share = F.expr("CASE WHEN full THEN cap ELSE ((parent_budget - filled) * weight) DIV (all_weight - filled_weight) END")
    return full.withColumn("budget", share).select(*children.columns, "budget")


def leaf_budgets(
    leaves: DataFrame, levels: Sequence[str], weights: Mapping[str, Mapping[str, int]], budget: int, max_epochs: int = MAX_EPOCHS
) -> DataFrame:
    """(levels, held, budget) from (levels, held); a leaf below a weight of 0 gets nothing."""
    allowed = leaves
    for level in levels:
        allowed = allowed.withColumn(f"w_{level}", weight_of(level, weights)).filter(F.col(f"w_{level}") > 0)
    allowed = allowed.withColumn("cap", F.col("held") * max_epochs)
    given = None
    top = min(budget, allowed.agg(F.sum("cap")).first()[0] or 0)
    for depth in range(1, len(levels) + 1):
        path, above = list(levels[:depth]), list(levels[: depth - 1])
        nodes = allowed.groupBy(*path).agg(F.sum("cap").alias("cap"), F.first(f"w_{path[-1]}").alias("weight"))
        if given is None:
            nodes = nodes.withColumn("parent_budget", F.lit(top).cast("long"))
        else:
            nodes = nodes.join(given.withColumnRenamed("budget", "parent_budget"), above)
        given = _shared_out(nodes, above, path[-1:]).select(*path, "budget")
    return leaves.join(given, list(levels), "left").withColumn("budget", F.coalesce("budget", F.lit(0)).cast("long"))


def draw(id_col: Column, text_hash: Column, epoch: Column, seed: str = SEED) -> Column:
    """The place of a document in an epoch's order, as hexadecimal digits."""
    name = F.coalesce(id_col.cast("string"), F.lit(""))
    return F.md5(F.concat_ws(":", F.lit(seed), epoch.cast("string"), name, text_hash).cast("binary"))


def selection(
    docs: DataFrame,
    levels: Mapping[str, str],
    weights: Mapping[str, Mapping[str, int]],
    share: Fraction = SHARE,
    max_epochs: int = MAX_EPOCHS,
    seed: str = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: id, text_hash, levels, tokens, budget of its leaf and how often it is taken.

    ``levels`` gives the tree from the top down: a name and the SQL expression of a row's node.
    """
    names = list(levels)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = stored(
        docs.select(
            F.col(id_col).alias("id"),
            F.md5(text.cast("binary")).alias("text_hash"),
            *[F.coalesce(F.expr(node).cast("string"), F.lit("")).alias(name) for name, node in levels.items()],
            F.size(words(text)).cast("long").alias("tokens"),
        ),
        "mix-rows",
    )
    leaves = stored(rows.groupBy(*names).agg(F.sum("tokens").alias("held")), "mix-leaves")
    total = leaves.agg(F.sum("held")).first()[0] or 0
    plan = leaf_budgets(leaves, names, weights, int(total * share), max_epochs)
    plan = stored(
        plan.select(
            *names,
            "budget",
            F.expr("CASE WHEN held > 0 THEN budget DIV held ELSE 0 END").alias("epochs"),
            F.expr("CASE WHEN held > 0 THEN budget % held ELSE 0 END").alias("rest"),
        ),
        "mix-plan",
    )
    drawn = rows.join(plan, names).withColumn("draw", draw(F.col("id"), F.col("text_hash"), F.col("epochs"), seed))
    drawn = drawn.withColumn("bin", F.substring("draw", 1, 3))
    bins = drawn.groupBy(*names, "bin").agg(F.sum("tokens").alias("in_bin"))
    upto = F.sum("in_bin").over(Window.partitionBy(*names).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    edges = bins.withColumn("upto", upto).select(*names, "bin", "upto", (F.col("upto") - F.col("in_bin")).alias("below"))
    cut = drawn.join(edges, [*names, "bin"])
    at_edge = (F.col("upto") > F.col("rest")) & (F.col("below") <= F.col("rest"))
    clear = cut.filter(~at_edge).withColumn("taken", (F.col("upto") <= F.col("rest")).cast("int"))
    # Rows with equal draws are summed together, so they fall on the same side.
    reached = F.sum("tokens").over(Window.partitionBy(*names, "bin").orderBy("draw")) + F.col("below")
    edge = cut.filter(at_edge).withColumn("reached", reached)
    edge = edge.withColumn("taken", (F.col("reached") <= F.col("rest")).cast("int")).drop("reached")
    found = clear.unionByName(edge)
    return found.select("id", "text_hash", *names, "tokens", "budget", (F.col("epochs") + F.col("taken")).cast("long").alias("n_taken"))


def mixed(docs: DataFrame, levels: Mapping[str, str], weights: Mapping[str, Mapping[str, int]], **options) -> DataFrame:
    """The documents with all their columns, each as often as it is taken."""
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    taken = selection(docs, levels, weights, **options).filter("n_taken > 0").select("id", "text_hash", *levels, "n_taken").distinct()
    text = F.coalesce(F.col(text_col), F.lit(""))
    leaf = [F.coalesce(F.expr(node).cast("string"), F.lit("")).alias(f"row_{name}") for name, node in levels.items()]
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("row_key"), F.md5(text.cast("binary")).alias("row_hash"), *leaf)
    # The same id and text in another leaf has a budget of its own.
    same = rows["row_key"].eqNullSafe(taken["id"]) & (rows["row_hash"] == taken["text_hash"])
    for name in levels:
        same &= rows[f"row_{name}"] == taken[name]
    met = rows.join(taken, same)
    return met.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_taken")))).select("row.*")
