"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertloom.llm.common import stored

MOST_ROUNDS = 100


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links each node's larger (or smaller) neighbours to the least of its neighbours and itself.

    The least neighbour is an aggregate joined back, so a node with very many
    neighbours is not gathered anywhere, and a skewed join can be split.
    """
    if large:
        pairs = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = pairs.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low"))
    joined = pairs.join(least, "a")
    if large:
        linked = joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        own = least.select("a", F.col("low").alias("b"))
        linked = joined.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(own)
    return linked.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``a, b`` for every node a of the undirected ``edges(a, b)`` but the least of each component; b is that least.

    Every round writes its edges to the shared folder; it stops when all edges are stars, about
    the logarithm of the longest path later.
    """
    edges = stored(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    for _ in range(MOST_ROUNDS):
        edges = stored(_star(_star(edges, large=True), large=False), "edges")
        ends = edges.select(F.col("b").alias("a")).distinct()
        crossed = edges.join(ends, "a", "left_semi").limit(1).count()
        doubled = edges.groupBy("a").agg(F.count("*").alias("n")).filter("n > 1").limit(1).count()
        if not crossed and not doubled:
            return edges
    raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
