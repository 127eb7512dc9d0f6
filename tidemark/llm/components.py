"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import saved


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One round of large-star or small-star: links (a, b), a > b, become links towards the least known neighbour."""
    ends = links.select("a", "b")
    if large:
        ends = ends.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = ends.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    ends = ends.join(least, "a")
    if large:
        out = ends.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = ends.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return out.where("a > b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (a, b): the least node that it reaches.

    Alternating large-star and small-star rounds; every round is a few joins on a node, whose rows are as many as the
    links, and is saved. Repeated links, links of a node with itself and an empty table are allowed.
    """
    links = saved(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        links = saved(_star(_star(links, large=True), large=False))
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == state:
            return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(links.select("b", "b").distinct())
        state = now
