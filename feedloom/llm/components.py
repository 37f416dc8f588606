"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.tables import stored


def _least(pairs: DataFrame) -> DataFrame:
    """For every ``u`` the smallest of itself and its ``v``; partial minima cross the shuffle."""
    return pairs.groupBy("u").agg(F.least("u", F.min("v")).alias("low"))


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` of every node in ``links (a, b)``, the component being its smallest node.

    Links with a null end and links of a node to itself are left out. Each round links all greater
    neighbours of a node to its smallest one, and then all smaller neighbours likewise (Kiveris et al.
    2014), until nothing changes; the links become stars around the smallest nodes. Nothing is
    collected, and a node with very many neighbours is a skewed join, not a group.
    """
    ends = links.where("a != b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    edges = stored(ends.distinct(), "links")
    seen = None
    while True:
        both = edges.union(edges.select("v", "u"))
        large = both.join(_least(both), "u").where("v > u").select("v", "low")
        large = large.toDF("u", "v").where("u != v").distinct()
        low = _least(large)
        small = large.join(low, "u").select("v", "low").union(low.select("u", "low"))
        small = small.toDF("u", "v").where("u != v").distinct()
        edges = stored(small, "links")
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    found = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return found.union(edges.select("v", "v").distinct().toDF("node", "component"))
