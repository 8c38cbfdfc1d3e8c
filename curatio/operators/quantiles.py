"""Exact, skew-safe quantiles and mode per group.

Spark's exact ``percentile`` keeps a count per distinct value of a group in
one aggregation buffer, and its final merge for a group runs in one task.
For a group that holds a large share of the rows this is the whole group in
one task.  Here:

1. value histogram ``(group, value) -> count``: a partially aggregated
   ``groupBy`` whose shuffle key includes the value, so a hot group's values
   spread over all tasks;
2. the histogram is range-partitioned by group and value and written
   (``segmented.spread``): cells of about equally many histogram rows, whatever
   range the values have.  A cell's count and the running counts over a group's
   cells, a small table, tell which cells hold the wanted ranks;
3. only those cells, at most two a probability and group, are read again and
   get running counts of their own; the two order statistics around
   ``(n - 1) p`` are picked and interpolated with Spark's formula
   ``(hi - pos) x_lo + (pos - lo) x_hi`` (type 7, bit-identical to
   ``percentile``);
4. mode = the value with the largest ``(count, -value)`` (smallest value on a
   tie), from the cells' summaries.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curatio.functions.expr import as_col
from curatio.operators.segmented import spread


def group_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    v: str,
    probs: Sequence[float],
    names: Sequence[str],
    mode: str | None = "mode",
    rows: int | None = None,
) -> DataFrame:
    """Per group: one column per probability (``names``) and optionally the mode.

    ``rows``: histogram rows of a cell (default: by Spark's shuffle settings).
    """
    kc = [as_col(k) for k in keys]
    hist = df.where(as_col(v).isNotNull()).groupBy(*kc, as_col(v).cast("double").alias("hv__")).agg(
        F.count(F.lit(1)).alias("hc__")
    )
    named = [k.alias(f"k{i}") for i, k in enumerate(kc)]
    hist = spread(hist, [*keys, "hv__"], rows).withColumn("__key", F.struct(*named, F.col("__chunk").alias("chunk")))

    # one row a cell, then windows over the cells of a group
    cells = hist.groupBy("__key").agg(
        F.sum("hc__").alias("c__"), F.max(F.struct(F.col("hc__"), (-F.col("hv__")).alias("v"))).alias("__m"))
    group = Window.partitionBy(*[F.col(f"__key.k{i}") for i in range(len(kc))])
    upto = group.orderBy(F.col("__key.chunk")).rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(
        "__key", "c__", F.coalesce(F.sum("c__").over(upto), F.lit(0)).alias("before__"), F.sum("c__").over(group).alias("n__"),
        (-F.max("__m").over(group)["v"]).alias("mode__"))

    def ranks(p: float) -> tuple[Column, Column, Column]:
        pos = (F.col("n__") - 1) * F.lit(float(p))
        return pos, F.floor(pos), F.ceil(pos)

    def holds(r: Column, first: Column, count: Column) -> Column:
        return (first <= r) & (r < first + count)

    every = [r for p in probs for r in ranks(p)[1:]]
    wanted = cells.where(reduce(Column.__or__, [holds(r, F.col("before__"), F.col("c__")) for r in every], F.lit(not every)))
    got = hist.join(wanted, "__key")
    w = Window.partitionBy("__key").orderBy("hv__").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # 0-based rank of the value's first copy
    got = got.withColumn("first__", F.col("before__") + F.sum("hc__").over(w) - F.col("hc__"))
    aggs = [F.first("n__").alias("n__"), F.first("mode__").alias("mode__")]
    for i, p in enumerate(probs):
        _, lo, hi = ranks(p)
        aggs += [F.max(F.when(holds(r, F.col("first__"), F.col("hc__")), F.col("hv__"))).alias(f"__{side}{i}") for side, r in (("lo", lo), ("hi", hi))]
    got = got.groupBy(*kc).agg(*aggs)
    cols = []
    for i, (p, name) in enumerate(zip(probs, names)):
        pos, lo, hi = ranks(p)
        xlo, xhi = F.col(f"__lo{i}"), F.col(f"__hi{i}")
        cols.append(F.when(lo == hi, xlo).otherwise((hi - pos) * xlo + (pos - lo) * xhi).alias(name))
    return got.select(*kc, *cols, *([F.col("mode__").alias(mode)] if mode else []))


def group_mode(df: DataFrame, keys: Sequence[str], v: str, digits: int | None = None, out: str = "mode") -> DataFrame:
    """Most frequent value per group (smallest on a tie), optionally of the values
    rounded half-even to ``digits`` decimals; histogram + ``max_by``, both partial."""
    x = as_col(v).cast("double")
    if digits is not None:
        x = F.bround(x, digits)
    kc = [as_col(k) for k in keys]
    hist = df.where(as_col(v).isNotNull()).groupBy(*kc, x.alias("hv__")).agg(F.count(F.lit(1)).alias("hc__"))
    return hist.groupBy(*kc).agg(F.max_by("hv__", F.struct(F.col("hc__"), -F.col("hv__"))).alias(out))
