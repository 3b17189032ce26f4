"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rollmark.llm.stored import stored


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _tangled(links: DataFrame) -> DataFrame:
    """Nodes that keep the links from being stars: they hang from two nodes, or hang from one and
    carry others."""
    ends = links.select(F.col("u").alias("x"), F.lit(1).alias("up")).unionByName(
        links.select(F.col("v").alias("x"), F.lit(0).alias("up")))
    return ends.groupBy("x").agg(F.sum("up").alias("up"), F.min("up").alias("least")).filter(
        "up > 1 or (up > 0 and least = 0)")


def components(links: DataFrame) -> DataFrame:
    """Links (u, v) of bigint ids -> (node, component) of every linked node; the component is its
    smallest node. Loops are ignored, repeated links do no harm.

    A node with very many links costs no task more than others: minima are combined before the
    shuffle, and joins split the rows of such a node. Each round is a table in the shared folder.
    """
    now = links.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    while True:
        now = stored(_small_star(_large_star(now)), "links")
        if _tangled(now).isEmpty():
            roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
