"""Distributed connected components by alternating large and small stars; no link list ever reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import discard, materialize


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of ``edges`` (a, b): root is the smallest node of its component. Any orderable type; null ends are dropped."""
    e = edges.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = materialize(e, "links")
    mark = _mark(e)
    while mark[0]:
        both = e.union(e.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.filter(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        large = materialize(large, "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        old, e = e, materialize(small.union(least.select("a", F.col("m").alias("b"))).distinct(), "small-star")
        discard(old, large)
        before, mark = mark, _mark(e)
        if before == mark:
            break
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
