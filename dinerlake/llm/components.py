"""Connected components by alternating large and small stars, on written edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dinerlake.llm.common import scratch, written


def settled(edges: DataFrame) -> bool:
    """Whether every node but the roots is tied to one node, a smaller one, and that is a root.

    Further stars would change nothing.  Repeated edges do not matter.
    """
    ends = edges.select(F.col("a").alias("node"), "b").union(
        edges.select(F.col("b").alias("node"), F.lit(None).alias("b")))
    nodes = ends.groupBy("node").agg(
        F.min("b").alias("low"), F.max("b").alias("high"), F.bool_or(F.col("b").isNull()).alias("parent"))
    wrong = F.col("low").isNotNull() & (
        (F.col("low") != F.col("high")) | F.col("parent") | (F.col("low") > F.col("node")))
    return not nodes.agg(F.coalesce(F.bool_or(wrong), F.lit(False))).first()[0]


def starred(edges: DataFrame, large: bool) -> DataFrame:
    """Every node's neighbours (the larger ones, or the others) tied to the least of them all.

    The large star gives at most one edge for each that it takes, so only the small star removes repeats.
    """
    if large:
        near = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = written(
        near.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low")),
        "least",
    )
    tied = near.join(least, "a")
    if large:
        return tied.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b"))
    out = tied.select(F.col("b").alias("a"), F.col("low").alias("b")).union(
        least.select("a", F.col("low").alias("b")))
    return out.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, root) for every node of ``edges`` (a, b); the root is the least node.

    Isolated nodes are not listed.  The edges of each round are written, never collected; rounds
    grow with the logarithm of the longest chain.
    """
    spark = edges.sparkSession
    with scratch(spark):
        edges = written(edges.where(F.col("a") != F.col("b")).select("a", "b"), "edges")
        while not settled(edges):
            with scratch(spark):
                edges = written(starred(written(starred(edges, True), "edges"), False), "edges", keep=True)
        roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        roots = roots.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
        return written(roots, "roots", keep=True)
