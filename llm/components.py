"""Connected components of a graph given as a table of links, by alternating star steps.

A large-star step links every neighbour that is larger than a node to the smallest of the
node and its neighbours, a small-star step links the smaller ones and the node itself
(Kiveris et al., "Connected Components in MapReduce and Beyond"). When nothing changes, every
node is linked to the smallest of its component. Each step is an aggregate with map-side
combining and a join that Spark splits at frequent keys; its result is written to the shared
folder, so a lost executor costs one step at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgauge.session import stage


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """From links (a, b) of any comparable type: a row (node, root) for every linked node but the roots.

    The root is the smallest node of the component. Links of a node to itself and repeated
    links do no harm; links with a null are left out.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = stage(links, "links")
    before = _state(links)
    while before[0]:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = stage(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = stage(moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "small-star")
        after = _state(links)
        if after == before:
            break
        before = after
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
