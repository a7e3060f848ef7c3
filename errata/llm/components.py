"""Connected components of a graph held in a DataFrame, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from errata.llm.common import forget, written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: each node hands its larger neighbours its least neighbour (or itself, if less).
    Small star: the same for its lesser neighbours and itself. Nodes with many neighbours are
    aggregated before the shuffle, and Spark splits them in the join.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    if large:
        pairs = edges.select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("p")).select("p.u", "p.v")
        least = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        return pairs.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()
    pairs = edges.select(high.alias("u"), low.alias("v"))
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    joined = pairs.join(least, "u")
    return joined.select(F.explode(F.array(F.struct(F.col("v").alias("a"), F.col("m").alias("b")), F.struct(F.col("u").alias("a"), F.col("m").alias("b")))).alias("p")).select("p.a", "p.b").filter("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge (a, b), longs; the root is the component's least node.

    Self-loops are ignored. The number of rounds grows with the logarithm of the longest chain.
    """
    now = written(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).filter("a != b").distinct(), "edges")
    before = None
    while not now.isEmpty():
        after = written(_star(_star(now, large=True), large=False), "stars")
        state = tuple(after.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        forget(now)
        now = after
        if state == before:
            break
        before = state
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
