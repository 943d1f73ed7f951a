"""Connected components of a link table by alternating large-star and small-star rounds.

Every round is two groupings with map-side minima and joins; a node with a third of all links is
an ordinary skewed join for AQE.  Nothing is collected but one row of sums per round, which tells
whether the links have changed.  Rounds are written tables, so a lost executor repeats one at most."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _star(links: DataFrame, large: bool) -> DataFrame:
    """links (u, v), u > v.  Large star: neighbours above u go to the least neighbour of u (or u).
    Small star: neighbours below u, and u, go to the least one."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else links
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    moved = both.filter("v > u") if large else both
    out = moved.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        out = out.unionByName(least.select("u", F.col("m").alias("v")))
    return out.filter("u > v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(a, b) links between long ids -> (node, component), component the least node reachable.
    Self-links, repeated links and either direction are fine; nulls are dropped."""
    links = (links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
             .filter("a is not null and b is not null and u > v").distinct())
    links, seen = written(links, "links"), None
    while True:
        links = written(_star(_star(links, True), False), "links")
        # an order-free digest of the link set: unchanged after a round means every component is a star
        now = tuple(links.agg(F.count("*"), F.sum("v"), F.bit_xor(F.xxhash64("u", "v"))).first())
        if now == seen:
            return links.select(F.col("u").alias("node"), F.col("v").alias("component"))
        seen = now
