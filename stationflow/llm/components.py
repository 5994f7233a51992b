"""Connected components of a distributed edge list, with DataFrame operations only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from stationflow.session import materialise


def _compressed(parents: DataFrame) -> DataFrame:
    """(node, root) of a forest given as (node, root) with root < node: pointers jump until all name a root."""
    while True:
        up = parents.select(F.col("node").alias("root"), F.col("root").alias("above"))
        step = parents.join(up, "root", "left").select("node", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved"))
        step = materialise(step, "jump")
        moved = step.filter("moved").limit(1).count()
        parents = step.drop("moved")
        if not moved:
            return parents


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of `edges` (a, b); a component's name is its smallest node.

    Every node hooks onto its smallest smaller neighbour, the trees are
    compressed, and the edges between the remaining roots go round again. A hub
    costs a partial minimum, never a gathered neighbour list. Each round is
    written to the shared folder, so a lost executor repeats one step only.
    Null ends and self-loops are left out; an edge may be given repeatedly.
    """
    left = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    left = materialise(left, "edges")
    nodes = left.select(F.col("a").alias("node")).union(left.select("b")).distinct()
    forests = []
    while left.limit(1).count():
        hooks = left.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
        forest = _compressed(materialise(hooks, "hooks"))
        forests.append(forest)
        a, b = (forest.select(F.col("node").alias(x), F.col("root").alias(f"r{x}")) for x in "ab")
        lifted = left.join(a, "a", "left").join(b, "b", "left").select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
        lifted = lifted.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        left = materialise(lifted, "edges")
    label = nodes.withColumn("component", F.col("node"))
    step = lambda df, forest: df.join(forest.select(F.col("node").alias("component"), "root"), "component", "left").select("node", F.coalesce("root", "component").alias("component"))
    return materialise(reduce(step, forests, label), "components")
