"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) of every node in ``links(a, b)``.

    Each round is two aggregates and joins over the links and is stored, so nothing
    is recomputed when an executor is lost. Rounds grow with the logarithm of the
    longest path. Minima are aggregated before the shuffle, so a node with very many
    links is no hot group; empty links give an empty result, loops are ignored.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges = stored(edges, "links")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = large.distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        after = stored(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "links")
        moved = after.join(edges, ["u", "v"], "left_anti").limit(1).count() + edges.join(after, ["u", "v"], "left_anti").limit(1).count()
        edges = after
        if not moved:
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
