"""Connected components over a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import settled


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large: both directions, larger neighbours move to the smallest of the neighbourhood. Small: only smaller neighbours."""
    if large:
        near = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    # combined inside each task first; the join back has one small row per node, and Spark splits hot nodes
    low = near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    joined = near.join(low, "u")
    moved = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")) if large else joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
    return moved.where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """links (a, b) -> (node, root): every linked node with the smallest node that it reaches."""
    edges = settled(links.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v").distinct())
    state = lambda e: tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
    before = None
    while True:
        edges = settled(_star(_star(edges, large=True), large=False))
        now = state(edges)
        if now == before or not now[0]:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select("v", "v")).distinct()
