"""Connected components of a link table by alternating star contractions."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeproof.llm.common import spread_join, stored


def _print(df: DataFrame) -> tuple:
    """Equal for equal sets of links."""
    return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``id, component`` (the smallest id reachable) of every id in ``links (a, b)``.

    Every step makes stars smaller: first each node ties its larger neighbours to its
    smallest one, then its smaller neighbours. Steps are stored, so nothing is recomputed
    after a lost executor; a node's links are folded to their minimum before any shuffle, and
    those of a star's centre are dealt over many tasks.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                   .where("u > v").distinct(), "links")
    seen = _print(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        least = low.select("u", F.least("u", "m").alias("m"))
        large = spread_join(both.where("v > u"), least, "u", low.select("u", "n"), 2 * seen[0])
        large = stored(large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "links")
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = (spread_join(large, low.select("u", "m"), "u", low.select("u", "n"), 2 * seen[0])
                 .where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        edges = stored(small, "links")
        now = _print(edges)
        if now == seen:
            break
        seen = now
    # Now each node but a root has one link, to its root.
    return (edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
            .unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("component")))
            .distinct())
