"""Connected components of a graph of distinct nodes, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.shared import join_hot, written


def _sign(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v") % 1000003)).first())


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` for every node of ``edges`` (``u``, ``v``; longs, unlike, in any order).

    The root is the smallest node of the component, itself included.  Each round hangs all larger
    neighbours of a node on its smallest one, then all smaller ones; it ends when nothing changes,
    after about log2 of the longest path rounds.  Every round is a written table; only a count and a
    checksum reach the driver.  The edges of a hub, however many, may be split over tasks where they
    meet its smallest neighbour.  No edges, no rows.
    """
    now = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    sign = _sign(now)
    while sign[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = join_hot(both, least, ["u"]).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = join_hot(large, least, ["u"]).where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        before, sign = sign, _sign(now)
        if sign == before:
            break
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
