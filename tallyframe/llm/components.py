"""Connected components of a link table, by DataFrames alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.base import saved


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b")


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node of ``links`` (a, b) reaches. Nodes without links do not appear.

    Large-star and small-star in turn (Kiveris et al. 2014): each node links its larger, then its smaller neighbours to the least of its
    neighbourhood, until every node hangs on the least of its component. Each round is written to the scratch folder. Neighbourhoods are
    never gathered: only their minima are, by partial aggregation, so a node with very many links is no hot spot.
    """
    edges = saved(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links")
    while True:
        ways = _both_ways(edges)
        least = ways.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = ways.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = saved(large, "large-star")
        small_least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(small_least, "a")
        small = joined.select("a", F.col("m").alias("b")).union(joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")))
        after = saved(small.where("a <> b").distinct(), "small-star")
        changed = after.join(edges, ["a", "b"], "left_anti").limit(1).count() + edges.join(after, ["a", "b"], "left_anti").limit(1).count()
        edges = after
        if not changed:
            break
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots).groupBy("node").agg(F.min("component").alias("component"))
