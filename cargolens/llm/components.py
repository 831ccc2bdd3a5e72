"""Connected components by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cargolens.session import stage


def _smallest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("a").agg(F.min("b").alias("low"))


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b), component the smallest node.

    A large-star step hangs each node's greater neighbours on its smallest one, a small-star
    step hangs its smaller neighbours there, until nothing changes. Neighbours are never
    gathered: the smallest is an aggregate with a partial sum, the rest a join that splits hot
    nodes. The links of each round are stored, so a lost executor costs one round. Links with a
    null end and loops are left out.
    """
    edges = stage(links.where("a <> b").select(F.greatest("a", "b").alias("a"),
                                               F.least("a", "b").alias("b")).distinct(), "links")

    def fingerprint(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")),
                            F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first())

    before, now = None, fingerprint(edges)
    while now != before:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = _smallest(both).select("a", F.least("a", "low").alias("low"))
        large = stage(both.where("b > a").join(low, "a")
                      .select(F.col("b").alias("a"), F.col("low").alias("b")).distinct(), "large-star")
        low = _smallest(large)
        small = (large.join(low, "a").where("b <> low")
                 .select(F.col("b").alias("a"), F.col("low").alias("b"))
                 .union(low.select("a", F.col("low").alias("b"))))
        edges = stage(small.distinct(), "small-star")
        before, now = now, fingerprint(edges)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
