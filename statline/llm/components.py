"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import drop_scratch, saved


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (u, v: long); ``root`` is the smallest node it reaches.

    Each round ties all larger neighbours of a node to its smallest one, then all smaller ones, so
    paths halve and stars stay. Minima combine before the shuffle, the join back is left to adaptive
    splitting, and no node's neighbours are gathered in a list. Links to itself are ignored.
    """
    edges = saved(links.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = saved(both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct(), "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        tied = large.join(low, "u").where("v > low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        after = saved(tied.unionByName(low.withColumnRenamed("low", "v")).distinct(), "small-star")
        now = _state(after)
        drop_scratch(edges, large)
        edges, before, state = after, state, now
        if now == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
