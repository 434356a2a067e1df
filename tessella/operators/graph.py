"""Connected components by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..sources.scratch import keep


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, component) of all nodes with an edge to another one; the component is its smallest node.

    Each round hangs a node's neighbours on the smallest of them, by joins and aggregates; only a count and a checksum a
    round reach the driver.
    """
    pairs, before = keep(edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).filter("u <> v").distinct()), None
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        seen = Observation()
        turned = small.unionByName(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        pairs = keep(turned.observe(seen, F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum")))
        state = seen.get
        if state == before:
            roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            return pairs.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component").unionByName(roots)
        before = state
