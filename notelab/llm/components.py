"""Connected components by alternating large-star and small-star steps.

Edges stay distributed in tables of the shared folder; each round costs a few
shuffles of (node, node) rows and the number of rounds grows with the
logarithm of the longest path; edges that are stars already take none.  The least neighbour of each node is written
before it is joined back, so that Spark deals both sides anew and splits the
edges of a node that a third of all others link to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notelab.llm.common import written


def _settled(edges: DataFrame) -> bool:
    """Whether the edges are stars already: every node has one edge down at
    most, and none that leads on from where an edge ends."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("end")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("end")))
    per = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("end").alias("end"))
    return not per.filter((F.col("down") > 1) | ((F.col("down") == 1) & (F.col("end") == 1))).limit(1).count()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = written(both.groupBy("u").agg(F.min("v").alias("m")), "star")
    return (both.join(least, "u").filter(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = written(edges.groupBy("u").agg(F.min("v").alias("m")), "star")
    pointed = edges.join(least, "u")
    return (pointed.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v"))))


def connected_components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """edges: two columns of longs, in either direction, repeats and loops
    allowed.  One row for each node that is not the least of its component:
    node, component (the least node of it).  Nulls link nothing."""
    a, b = edges.columns
    edges = (edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    edges = written(edges, "edges")
    for _ in range(rounds):
        if _settled(edges):
            break
        edges = written(_small_star(written(_large_star(edges).distinct(), "edges")).distinct(), "edges")
    else:
        raise RuntimeError(f"components not found in {rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
