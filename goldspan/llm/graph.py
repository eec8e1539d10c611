"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldspan.session import stored


def _star(links: DataFrame, upward: bool) -> DataFrame:
    """Links every neighbour of a node (upward: its larger ones; else its smaller ones) to the least node around it."""
    both = links.select(F.col("_u").alias("_x"), F.col("_v").alias("_y"))
    if upward:
        both = both.unionByName(links.select(F.col("_v").alias("_x"), F.col("_u").alias("_y")))
    # a crowded node is reduced before the shuffle here, and split by adaptive execution in the join
    least = both.groupBy("_x").agg(F.min("_y").alias("_m")).select("_x", F.least("_x", "_m").alias("_m"))
    moved = both.join(least, "_x")
    if upward:
        return moved.where(F.col("_y") > F.col("_x")).select(F.col("_y").alias("_u"), F.col("_m").alias("_v"))
    return moved.where(F.col("_y") != F.col("_m")).select(F.col("_y").alias("_u"), F.col("_m").alias("_v")).unionByName(
        least.select(F.col("_x").alias("_u"), F.col("_m").alias("_v")))


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``component`` (the least node reachable) for every node of ``links`` but the least ones themselves.

    Nulls and links of a node to itself count as no link; repeated links and
    either direction are fine. A node that is absent is its own component. The
    number of rounds grows with the logarithm of the longest chain; each round
    is written to the shared folder.
    """
    u, v = F.col(a), F.col(b)
    edges = links.where(u != v).select(F.greatest(u, v).alias("_u"), F.least(u, v).alias("_v")).distinct()
    before = None
    while True:
        edges = stored(edges, "links")
        now = tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("_u", "_v"))).first())
        if now == before or not now[0]:
            return edges.select(F.col("_u").alias("node"), F.col("_v").alias("component"))
        before = now
        edges = _star(_star(edges, upward=True), upward=False).where(F.col("_u") != F.col("_v")).distinct()
