"""Connected components of an edge table by alternating large-star and small-star steps (MapReduce connected components).

Every step is a window over one node's edges; nothing is collected, each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wagelens.llm.shared import written


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Edges (u, v) with u > v.  Large star: each node's greater neighbours hang on its least; small star: the others."""
    if small:
        each = edges
    else:
        each = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    node = Window.partitionBy("u")
    least = each.withColumn("least", F.least(F.min("v").over(node), F.col("u")))
    if small:
        hung = least.select(F.col("v").alias("u"), F.col("least").alias("v")).unionByName(least.select("u", F.col("least").alias("v")))
    else:
        hung = least.filter("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return hung.filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, component (least node of it) for every node of an edge; edges: long columns a, b."""
    now = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = None
    while True:
        now = written(_star(_star(now, small=False), small=True), "stars")
        found = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first()
        if tuple(found) == state:
            break
        state = tuple(found)
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
