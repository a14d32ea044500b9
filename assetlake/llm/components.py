"""Connected components of a graph of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetlake.llm.common import stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Each node hands its larger (large star) or smaller (small star) neighbours its least one."""
    sides = edges.select(F.col("u").alias("n"), F.col("v").alias("m"))
    if large:
        sides = sides.unionAll(edges.select(F.col("v").alias("n"), F.col("u").alias("m")))
    least = sides.groupBy("n").agg(F.least(F.min("m"), F.col("n")).alias("least"))
    met = sides.join(least, "n")
    if large:
        out = met.where(F.col("m") > F.col("n")).select(F.col("m").alias("u"), F.col("least").alias("v"))
    else:
        out = (met.select(F.col("m").alias("u"), F.col("least").alias("v"))
               .unionAll(least.select(F.col("n").alias("u"), F.col("least").alias("v"))))
    return out.where(F.col("u") > F.col("v")).distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node with a link; a component is named by its least node.

    ``links`` are pairs of comparable ids; nulls and self links are dropped. The edges are written
    after each round. Nothing but two counts a round reaches the driver; rounds grow with the
    logarithm of the largest component.
    """
    x, y = F.col(a), F.col(b)
    edges = stage(links.where(x.isNotNull() & y.isNotNull() & (x != y))
                  .select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct(), "edges")
    while True:
        # done when each node hangs on one smaller node that hangs on none
        seen = edges.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("u").alias("u")).first()
        if seen["n"] == seen["u"] and edges.join(edges.select(F.col("u").alias("v")), "v", "left_semi").isEmpty():
            break
        edges = stage(_star(_star(edges, True), False), "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
