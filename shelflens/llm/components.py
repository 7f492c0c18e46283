"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelflens.llm.common import write_once


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("hi", "lo").union(edges.select(F.col("lo"), F.col("hi"))).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = edges.join(least, "hi").filter("lo <> m").select(F.col("lo").alias("hi"), "m")
    return moved.union(least).toDF("hi", "lo").distinct()


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first())


def components(links: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` (long) to rows ``node``, ``root``: the smallest node of its component.

    Roots themselves and nodes without a link are not listed. Rounds grow with the
    logarithm of the longest chain; each is written, so that no lineage builds up.
    Starts jobs.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    edges = write_once(edges, "edges")
    before = _signature(edges)
    while before[0]:
        edges = write_once(_small_star(_large_star(edges)), "edges")
        after = _signature(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
