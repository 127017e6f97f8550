"""Connected components of links by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from mailshape.session import land


def _both(links: DataFrame) -> DataFrame:
    return links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _smallest(links: DataFrame) -> DataFrame:
    return links.groupBy("a").agg(F.min("b").alias("_m")).select(
        F.col("a").alias("_a"), F.least("a", "_m").alias("_m"))


def _star(links: DataFrame, keep) -> DataFrame:
    joined = links.join(_smallest(links), F.col("a") == F.col("_a"))
    return joined.filter(keep).select(F.col("b").alias("a"), F.col("_m").alias("b"))


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` of every node of ``links`` (columns ``a``, ``b``); ``root`` is the smallest.

    Links with a null end or equal ends do nothing. Each step is a join with one row per node whose
    other side adaptive execution splits where a node has very many links; steps grow with the
    logarithm of the longest chain, and each is landed.
    """
    links = land(links.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = None
    while True:
        large = _star(_both(links), F.col("b") > F.col("a")).filter("a <> b").distinct()
        # Small star: a node's smaller neighbours, and the node itself, point to the smallest.
        small = _smallest(large)
        step = large.join(small, F.col("a") == F.col("_a")).select(
            F.col("b").alias("a"), F.col("_m").alias("b")).unionAll(
                small.select(F.col("_a").alias("a"), F.col("_m").alias("b")))
        links = land(step.filter("a <> b").distinct(), "links")
        now = tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == seen:
            break
        seen = now
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
