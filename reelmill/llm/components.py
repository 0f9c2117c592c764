"""Connected components of a link table, as a few rounds of joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmill.llm.shared import drop_frozen, frozen


def connected_components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node reachable, for every node of the links (``a``, ``b``: long).

    Alternating stars: every node hangs its larger neighbours below its smallest one, then its smaller neighbours and
    itself, until nothing changes; the rounds grow with the logarithm of the longest chain. Each round is a table in the
    shared folder. Missing ends and links of a node to itself are left out.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = frozen(edges, "links")
    before = None
    while True:
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before:
            break
        before = now
        both = edges.select("u", "v").union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        large = frozen(large, "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(low, "u").where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v")).union(
            low.select("u", "low")).distinct()
        small = frozen(small, "small-star")
        drop_frozen(large)
        drop_frozen(edges)
        edges = small
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select("v", "v").distinct())
