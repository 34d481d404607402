"""Connected components of a table of links."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwise.llm.shared import store


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Links (a > b). Large: every larger neighbour of a node goes to the node's least neighbour; small: every smaller."""
    ways = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        ways = ways.unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = ways.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    moved = ways.join(least.withColumnRenamed("u", "w"), F.col("u") == F.col("w")).where(F.col("v") > F.col("u") if large else F.col("v") != F.col("m")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    if not large:
        moved = moved.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return moved.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component): the least node that can be reached, for every node of ``links`` (columns a and b, longs).

    Alternating large and small stars; each round stores its links in the shared folder. A node with many links is
    never gathered: minima are combined map-side, and the join back is one that Spark can split.
    """
    now = store(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
        before = state
        now = store(_star(_star(now, True), False), "links")
