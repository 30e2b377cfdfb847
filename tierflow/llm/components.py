"""Connected components of links by alternating large and small stars; nodes and links stay distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import frozen
from tierflow.operators.joins import join_per_key


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Tie neighbours to the smallest node around: the larger neighbours, or the smaller ones and the node itself."""
    if large:
        around = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        around = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = around.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))
    met = join_per_key(around, least, "a")  # a node with very many neighbours is dealt over several tasks
    if large:
        tied = met.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        tied = met.select(F.explode(F.array("a", "b")).alias("a"), F.col("low").alias("b"))
    return tied.where("a != b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component): every node that occurs in `links` (columns a and b, long) with the smallest node it reaches.

    Null ends and links of a node to itself are ignored. No links give no rows.
    """
    edges = frozen(links.where("a IS NOT NULL AND b IS NOT NULL AND a != b").select("a", "b").distinct(), "links")
    before = None
    while True:
        edges = frozen(_star(_star(edges, True), False), "links")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_000_007)).first()
        if state == before:
            break
        before = state
    tops = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(tops.select("node", F.col("node").alias("component")))
