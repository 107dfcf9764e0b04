"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rectext.llm.common import saved


def _signature(edges: DataFrame):
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` (smallest reachable node) for every node that has
    a link to another one. Nodes are longs; direction, repeats and loops of
    ``links`` don't matter, no links give no rows.

    Each round writes its edges to the shared folder; only their number and
    a checksum come to the driver. A node with very many neighbours is
    summed up by partial minima and joined, never collected."""
    e = saved(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v").distinct(), "edges")
    seen = _signature(e)
    while seen[0]:
        both = e.select(F.col("u").alias("x"), F.col("v").alias("y")).unionByName(
            e.select(F.col("v").alias("x"), F.col("u").alias("y")))
        least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.join(least, "x").filter("y > x").select(F.col("y").alias("u"), F.col("m").alias("v")).distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(lower, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(lower.select("u", F.col("m").alias("v"))))
        e = saved(small.distinct(), "edges")
        now = _signature(e)
        if now == seen:
            break
        seen = now
    nodes = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(nodes.select(F.col("component").alias("node"), "component").distinct())
