"""Connected components of a distributed graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rimstone.llm.common import materialize


def components(edges: DataFrame) -> DataFrame:
    """`node`, `component` (its smallest reachable node) for every node of the edges `a`, `b` (longs).

    Each round but the first orders the nodes anew by a hash. Every node points to the first of itself and its neighbours, pointers are
    followed once more, and the edges between different targets make the next graph. In a fresh random order a node is
    seldom first among its neighbours, so a graph loses most of its nodes each round whatever its shape, chains too, and
    rounds grow with the logarithm of the number of nodes. Rounds are written tables, so no lineage grows, and a node
    with any number of edges is only ever reduced to a minimum. Components are then looked up from the last and smallest
    graph back to the first, and named by their smallest node.
    """
    rounds = []
    left = materialize(edges.where("a <> b").select("a", "b").distinct(), "edges")
    while not left.isEmpty():

        def order(node: str, number: int = len(rounds)) -> Column:
            # First by number, which settles stars around their smallest node at once, then by hashes.
            h = F.xxhash64(F.col(node), F.lit(number)) if number else F.lit(0).cast("long")
            return F.struct(h.alias("h"), F.col(node).alias("id"))

        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = both.groupBy(F.col("a").alias("node")).agg(F.min(order("b")).alias("low"))
        first = first.select("node", F.least(order("node"), "low")["id"].alias("to"))
        again = first.select(F.col("node").alias("to"), F.col("to").alias("target"))
        step = materialize(first.join(again, "to").select("node", "target"), "pointers")
        rounds.append(step)
        for end in ("a", "b"):
            at = step.select(F.col("node").alias(end), F.col("target").alias(f"new_{end}"))
            left = left.join(at, end)
        moved = left.select(F.least("new_a", "new_b").alias("a"), F.greatest("new_a", "new_b").alias("b"))
        left = materialize(moved.where("a <> b").distinct(), "edges")
    if not rounds:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    found = rounds[-1].select("node", F.col("target").alias("root"))
    for step in reversed(rounds[:-1]):
        later = found.select(F.col("node").alias("target"), "root")
        found = step.join(later, "target", "left").select("node", F.coalesce("root", "target").alias("root"))
    found = materialize(found, "roots")
    names = found.groupBy("root").agg(F.min("node").alias("component"))
    return found.join(names, "root").select("node", "component")
