"""Components of a graph of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.session import materialize


def components(links: DataFrame, name: str = "links") -> DataFrame:
    """Links ``(a, b)`` of longs -> ``(node, root)``, the smallest node reachable by links.

    Every node of a link gets a row. Alternating large and small stars: each round
    hangs the neighbours of a node on the smallest of them, and the rounds grow
    with the logarithm of the longest chain. Rounds are written to the shared
    folder; only their row counts and checksums reach the driver.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct()
    edges = materialize(edges, name)
    seen = None
    while True:
        now = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("s")).first()
        if now["n"] == 0 or (now["n"], now["s"]) == seen:
            break
        seen = (now["n"], now["s"])
        # Large star: neighbours above a node go to its smallest neighbour.
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m")).select("w", F.least("w", "m").alias("m"))
        large = both.join(low.hint("merge"), both["u"] == low["w"]).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        # Small star: a node and its lower neighbours go to the smallest of these.
        least = large.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
        small = large.join(least.hint("merge"), large["u"] == least["w"])
        small = small.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = materialize(small.select("e.u", "e.v").filter("u > v").distinct(), name)
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
