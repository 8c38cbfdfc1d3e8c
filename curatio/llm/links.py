"""Connected components of a link table by alternating stars (min-label contraction)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatio.llm.common import durable


def _mark(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(a, b) links -> (node, component): the smallest node reachable, one row a linked node.

    Each round hangs the larger neighbours of every node, then the smaller
    ones, on the smallest of its neighbourhood; after a number of rounds that
    grows with the logarithm of the longest chain only stars are left.  A node
    with very many links is only ever aggregated or joined, never collected.
    Self links and repeated links change nothing; null ends are ignored.
    """
    e = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    e = durable(e.distinct())
    before = None
    while (now := _mark(e)) != before:
        before = now
        if not now[0]:
            break
        # large star: neighbours above u go to the smallest of u and its neighbours
        both = e.select("u", "v").union(e.select(F.col("v"), F.col("u")))
        m = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(m, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = durable(large)
        # small star: u and its smaller neighbours go to the smallest of them
        m = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(m, "u")
        small = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).union(hung.select("u", F.col("m").alias("v")))
        e = durable(small.where("u <> v").distinct())
    star = e.groupBy("u").agg(F.min("v").alias("v"))
    return star.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        e.select(F.col("v"), F.col("v")).distinct()
    )
