"""Connected components by alternating large-star and small-star, one shuffle join and one aggregation each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch


def _with_least(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with ``m``, the least of u and all its v. The aggregate combines map-side, and the join's
    skewed partitions can be split, so a node with very many neighbours never meets in one task."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(least, "u").withColumn("m", F.least("u", "m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of u is linked to the least of u's neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours are linked to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    linked = _with_least(down)
    return (linked.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(linked.select("u", F.col("m").alias("v")))
            .where(F.col("u") != F.col("v")).distinct())


def connected_components(edges: DataFrame, scratch: Scratch, max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node of ``edges`` (u, v); the component is its least node.

    Nodes are of one type that can be ordered. Null ends and self-links are dropped. Rounds stop when a
    round changes no edge (compared by count and an order-free checksum).
    """
    state = (edges.where(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v")))
             .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state, mark = scratch.write_marked(state, "edges")
    for _ in range(max_rounds):
        if not mark[0]:
            break
        after, then = scratch.write_marked(_small_star(_large_star(state)), "edges")
        scratch.drop(state)
        state, before, mark = after, mark, then
        if before == mark:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = state.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return state.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
