"""Connected components of an edge table by alternating large and small
stars, each round a table in the shared folder.

A round is two joins and two partial aggregations on the edges; a hub's
edges are one side of a join, which adaptive execution can split.  Nothing
about the graph but two numbers per round reaches the driver.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage_table


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node that has an edge to another one; root is
    the component's smallest node.  Null ends and loops are ignored."""
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    e, was = stage_table(e, "edges"), None
    while True:
        # large star: every larger neighbour of u goes to the least of u's neighbourhood
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where(
            "u <> v").distinct()
        # small star: u and its smaller neighbours go to the least of these
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        e = stage_table(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = e.agg(F.count("u"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == was:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                e.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
        was = now
