"""Connected components of a graph given as links, by alternating large-star and small-star.

Each round rewrites the links so that every node points at smaller nodes, until
all links of a component point at its smallest node. The neighbour minimum is a
``groupBy`` (combined before the shuffle) joined back to the links, so a node
with very many links is split by the skew join and never gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch


def _star(links: DataFrame, low: str, high: str) -> DataFrame:
    least = links.groupBy(high).agg(F.min(low).alias("_least"))
    return links.join(least, high)


def large_star(links: DataFrame) -> DataFrame:
    """Connect every larger neighbour of u with the smallest of u and its neighbours."""
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (_star(both, "v", "u").where("v > u")
            .select(F.col("v").alias("u"), F.least("_least", "u").alias("v")).where("u <> v").distinct())


def small_star(links: DataFrame) -> DataFrame:
    """Connect u and its smaller neighbours with the smallest of them. Expects u > v."""
    joined = _star(links, "v", "u")
    return (joined.select(F.explode(F.array("u", "v")).alias("u"), F.col("_least").alias("v"))
            .where("u <> v").distinct())


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``links``: columns u, v (long). Returns (node, component) for every node but the smallest of its component.

    Null ends, loops, repeated and reversed links are allowed; no links give no rows.
    """
    now = scratch.save(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                       .where("u <> v").distinct(), "links")
    mark = None
    while True:
        new = scratch.save(small_star(large_star(now)), "links")
        scratch.drop(now)
        now = new
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark or not seen[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        mark = seen
