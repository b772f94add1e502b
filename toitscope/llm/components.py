"""Connected components of a large graph by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toitscope.llm.shared import drop, staged


def _ordered(a: str, b: str) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for every node of ``edges`` (columns ``a`` and ``b``).

    In a round every node points at the least of itself and its neighbours and then at what that one points at;
    edges are redrawn between the nodes pointed at, and those inside a component vanish. Each round at least halves
    the components' nodes, so the rounds grow with the logarithm of the largest component. Tables of a round are
    written to the shared folder; nothing but a count reaches the driver. Edges with a null end and loops are
    ignored; repeated ones count once; without edges there are no nodes.
    """
    edges = staged(edges.where("a != b").select(*_ordered("a", "b")).distinct(), "edges")
    rounds = []
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy(F.col("a").alias("node")).agg(F.least("a", F.min("b")).alias("root"))
        onward = least.select(F.col("node").alias("root"), F.col("root").alias("further"))
        step = staged(least.join(onward, "root").select("node", F.col("further").alias("root")), "contraction")
        first = edges.join(step.select(F.col("node").alias("a"), F.col("root").alias("x")), "a").select("x", "b")
        both = first.join(step.select(F.col("node").alias("b"), F.col("root").alias("y")), "b").where("x != y")
        shorter = staged(both.select(*_ordered("x", "y")).distinct(), "edges")
        drop(edges)
        edges = shorter
        rounds.append(step)
    if not rounds:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = rounds.pop()
    while rounds:
        later = out.select(F.col("node").alias("root"), F.col("root").alias("further"))
        out = rounds.pop().join(later, "root", "left").select("node", F.coalesce("further", "root").alias("root"))
    return out
