"""Connected components of a link table, by alternating large and small stars, all in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrolite.llm.common import drop, frequent_from, spread_join, stash


#: Links of a node (16 bytes each) that one task takes without being slow or large; a node with more is a hub.
HUB_LINKS = 1 << 18


def _oriented(edges: DataFrame) -> DataFrame:
    """Each link once, from its larger end ``u`` to its smaller end ``v``."""
    return edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u long, v long) links to (node long, component long): the smallest node that each linked node reaches.

    Nodes without links are not returned. A star step is one aggregation (the smallest neighbour, combined before it
    is shuffled) and one join, in which the links of a node with very many stay where they are. Rounds grow with the
    logarithm of the longest chain. Null ends and self links are left out; no links give no rows.
    """
    spark = edges.sparkSession
    now = stash(_oriented(edges))
    mark = None
    while True:
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        h = F.when(F.col("v") < F.col("u"), F.xxhash64("u", "v").cast("decimal(38,0)"))
        degrees = both.groupBy("u").agg(F.count(F.lit(1)).alias("n"), F.sum(h).alias("h"))
        seen = degrees.agg(F.sum("n").alias("n"), F.sum("h").alias("h"), F.max("n").alias("most")).first()
        if seen == mark or not seen["n"]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        mark = seen
        # No node gets more links by a step than it has now, so that few jobs do where there is no hub.
        hubs = seen["most"] > frequent_from(seen["n"], HUB_LINKS)
        held = stash if hubs else (lambda x: x)
        joined = spread_join if hubs else (lambda rows, one, on, _: rows.join(one, on))
        # Large star: every larger neighbour of a node is linked to the node's smallest neighbour (or the node).
        least = held(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"), F.count_if(F.col("v") > F.col("u")).alias("n")))
        large = held(joined(both.where("v > u"), least.where("n > 0"), "u", HUB_LINKS).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # Small star: a node's smaller neighbours are linked to the smallest of them.
        lower = held(large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")))
        rest = joined(large, lower, "u", HUB_LINKS).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = stash(rest.union(lower.select("u", F.col("m").alias("v"))).distinct())
        for used in (now, least, large, lower) if hubs else (now,):
            drop(spark, used)
        now = small
