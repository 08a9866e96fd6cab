"""Connected components of a graph of links, by rounds of joins.

Each round links every node to its least neighbour (large star, small star) and
keeps linear space: hubs are aggregated, never collected. Links are staged
after each round, so lost executors recompute one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipsense.session import staged


def _star(links: DataFrame, large: bool) -> DataFrame:
    """New links (a > b) from each node's neighbours to the least of them and the node itself."""
    if large:
        both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = links
    least = both.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("least", "a"))
    met = both.join(least, "a")
    if large:
        return met.filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
    own = least.filter("least < a").select("a", F.col("least").alias("b"))
    return met.filter("b > least").select(F.col("b").alias("a"), F.col("least").alias("b")).union(own).distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """node and component, the least node of it; nodes without a link do not appear.

    The ids must be ordered and not null; links of a node to itself are ignored.
    """
    pairs = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a > b").distinct()
    state = staged(pairs)
    mark = None
    while True:
        state = staged(_star(_star(state, True), False))
        now = tuple(state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == mark:
            break
        mark = now
    roots = state.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return state.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
