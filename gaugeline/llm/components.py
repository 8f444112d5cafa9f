"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import stored
from gaugeline.session import release


def _distinct(edges: DataFrame) -> DataFrame:
    return edges.filter("u <> v").select("u", "v").distinct()


def _state(edges: DataFrame) -> tuple:
    """Tells one set of links from another: their number and a sum over their hashes."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """`node, root` for every node of the links `u, v` (whole numbers); the root is the least node that it reaches.

    Each round hangs larger neighbours, then smaller ones, on the least node that a node sees, until nothing changes;
    rounds grow with the logarithm of the longest chain. A round is two joins on the node: links of a node with many
    neighbours are spread by the adaptive skew join, and minima are taken before the shuffle. Every round's links are
    written to the shared scratch folder, so a lost executor costs a re-read. The driver sees two numbers a round.
    """
    ordered = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = stored(_distinct(ordered), "links")
    before, state = None, _state(now)
    while state != before:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _distinct(both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        large = stored(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = stored(_distinct(small.unionByName(least.select("u", F.col("m").alias("v")))), "small-star")
        release(now, large)
        now, before, state = after, state, _state(after)
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
