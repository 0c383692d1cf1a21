"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arbiter.llm.common import hot_join, stage


def _star(links: DataFrame, both_ways: bool) -> DataFrame:
    """One step over ``links`` (a, b; a > b). Large star (``both_ways``) hangs a node's larger neighbours
    onto its smallest; small star hangs the node and its smaller neighbours onto it."""
    near = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if both_ways:
        near = near.unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = stage(near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n")), "star")
    total = least.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    joined = hot_join(near, least, ["u"], "n", total)
    if both_ways:
        return joined.filter("v > u and v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
    hung = joined.filter("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return hung.unionByName(least.filter("u <> m").select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``links``: a, b (long). Returns node, root: every linked node with the smallest node it reaches.

    Each round writes its links to the shared folder; rounds grow with the logarithm of a component's
    width. It ends when a round leaves the links as they were (their number and hash sum).
    """
    now = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, seen = stage(now, "links"), None
    while True:
        sign = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if sign == seen or not sign[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        seen = sign
        now = stage(_star(stage(_star(now, True), "links"), False), "links")
