"""Connected components as Spark jobs: alternating large and small stars.

Each round hangs the neighbours of a node on the least of them, first the larger ones, then
the smaller ones. Rounds end when the edges no longer change; by then every edge points at
the least node of its component. Degrees are only ever aggregated, never gathered, and
each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readmill.session import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
        edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    )
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    hung = edges.join(least, "hi").where("lo > m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return hung.unionByName(least.select("hi", F.col("m").alias("lo"))).distinct()


def _state(edges: DataFrame):
    return edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(20,0)")).alias("s")).first()


def components(links: DataFrame) -> DataFrame:
    """(node, label) for the nodes of the links (a, b): the least node that is reachable."""
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    edges = materialise(edges, "links")
    state = _state(edges)
    while state["n"]:
        edges = materialise(_small_star(_large_star(edges)), "stars")
        after = _state(edges)
        if after == state:
            break
        state = after
    nodes = edges.select(F.col("hi").alias("node"), F.col("lo").alias("label"))
    return nodes.unionByName(edges.select(F.col("lo").alias("node"), F.col("lo").alias("label")).distinct())
