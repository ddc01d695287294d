"""Connected components by alternating large and small stars over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reglink.llm.stage import stage


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
    return tuple(row)


def _large(edges: DataFrame) -> DataFrame:
    """Every node hands the smallest node around it to its larger neighbours."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m")).select("c", F.least("c", "m").alias("m"))
    return (both.join(least, both.u == least.c).where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small(edges: DataFrame) -> DataFrame:
    """Every node hands the smallest of its smaller neighbours to the others and itself."""
    least = edges.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m"))
    moved = (edges.join(least, edges.u == least.c).where(F.col("v") != F.col("m"))
             .select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")))
    return moved.unionAll(least.select(F.col("c").alias("u"), F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (two long columns); root is the smallest node of
    its component.  Minimum and join per node only: no node's neighbours are collected, and a
    hub's rows can be split by a skew join.  Each round is staged in the shared folder."""
    a, b = edges.columns
    held = stage(edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    mark = _mark(held)
    while mark[0]:
        held = stage(_small(_large(held)), "edges")
        now = _mark(held)
        if now == mark:
            break
        mark = now
    stars = held.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionAll(stars.select(F.col("root").alias("node"), "root").distinct())
