"""Connected components of an edge table, by alternating large and small stars.

All steps are joins and aggregations; nothing is gathered on the driver but two numbers
per round. Every round is written to the shared folder, so a lost executor costs at most
one round, and takes the place of the one before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from classmap.plans.settle import release, settle


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every edge goes from a larger ``a`` to a smaller ``b``."""
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    others = edges.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b")
    return others.union(low.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node that an edge of ``a, b`` (longs) touches, except the
    roots themselves; the root is the smallest node reachable. Loops and repeated edges
    are allowed; an empty table gives an empty one."""
    turned = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    at = settle(turned.where("a > b").distinct(), "edges")
    before = None
    while True:
        row = at.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if row[0] == 0 or tuple(row) == before:
            return at.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = tuple(row)
        large = _large_star(at).distinct()
        last, at = at, settle(_small_star(large).distinct(), "edges")
        release(last)
