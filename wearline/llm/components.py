"""Connected components of a table of links, with alternating large and small stars.

Every step is a grouped minimum and a join on node ids; no group is gathered, and each
step is written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return both.filter("v > u").join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node``, ``label`` of every node of ``links`` (u, v): label is the least node reachable.

    Nodes without links don't appear; loops and repeated links change nothing.
    """
    links = links.filter("u != v").select(F.col("u").cast("long"), F.col("v").cast("long"))
    state, last = written(_small_star(links), "links"), None
    while True:
        now = tuple(state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == last:
            break
        last = now
        state = written(_small_star(_large_star(state)), "links")
    label = state.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return label.unionByName(label.select(F.col("label").alias("node"), "label").distinct())
