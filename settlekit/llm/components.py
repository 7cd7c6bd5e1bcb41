"""Connected components of an edge table, by alternating large-star and small-star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settlekit.llm.blocks import shared_table


def _large_star(e: DataFrame) -> DataFrame:
    ways = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    both = e.select(F.inline(ways))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(e: DataFrame) -> DataFrame:
    """Of edges that lead to a smaller node; one edge for each, so repeats need no removal."""
    least = e.groupBy("a").agg(F.min("b").alias("m"))
    return e.join(least, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"),
                                     F.col("m").alias("b"))


def _are_stars(e: DataFrame) -> bool:
    """Does every edge lead from a node that has no other edge, but repeats, to a root that leads nowhere?"""
    none = F.lit(None).cast(e.schema["b"].dataType)
    ends = e.select(F.inline(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("to")),
                                     F.struct(F.col("b").alias("node"), none.alias("to")))))
    per_node = ends.groupBy("node").agg(F.min("to").alias("low"), F.max("to").alias("high"),
                                        F.count("to").alias("leads"), F.count(F.lit(1)).alias("n"))
    return per_node.where("low != high OR (leads > 0 AND n > leads)").isEmpty()


def stars(edges: DataFrame) -> DataFrame:
    """``(a, b)`` for every node ``a`` but the least of each component, ``b``; rows may repeat.

    Each round is written to the shared folder and has no more rows than ``edges``. Further edges may be added to a
    result: the stars and they have the components of all edges together.
    """
    e = edges.select("a", "b").where("a != b")
    while True:
        e = shared_table(edges.sparkSession, _small_star(_large_star(e)), "edges")
        if _are_stars(e):
            return e


def parents(star: DataFrame) -> DataFrame:
    """``(node, component)`` of the nodes of ``stars`` but the roots, once each."""
    return star.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))


def members(star: DataFrame) -> DataFrame:
    """``(node, component)`` of the nodes of ``stars``, roots included, once each."""
    roots = star.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return parents(star).unionByName(roots)


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``; component = its least node."""
    return members(stars(edges))
