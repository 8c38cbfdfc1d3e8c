"""Detrended fluctuation analysis by merging boxes.

Peng et al. (1994): integrate the mean-centred series, cut it into boxes
of size n, remove a least-squares line per box, take the RMS residual F(n);
the scaling exponent is the slope of log F(n) against log n.

A box's regression needs only its count, the means of position and profile and
the centred sums of squares and products, and two neighbouring boxes of
one size merge into the next size from these numbers alone:

    M2 = M2a + M2b + d^2 m / 2,   C = Ca + Cb + d m^2 / 2,   d = mean_b - mean_a

(m samples in each half; the sum of squares of the positions is a constant of
the size).  So each sample is read once, for the smallest box: one row a box,
from a partial aggregate.  ``BLOCK`` boxes in a row form a block, the unit of
one task's work, whose inner sizes a vectorised function merges; what is left
of a block is one box, and blocks of blocks are merged in the same way until
none is complete.  A record with a third of all rows spreads over its blocks.

Conventions: box sizes are ``min_box`` (a power of two) times powers of two,
up to N/4; incomplete trailing boxes are dropped; box sizes with a perfect line fit
(F = 0) are skipped.  A record too short for one box size, or with fewer than
two box sizes left, keeps its row with a NULL exponent.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatio.functions.expr import as_col
from curatio.operators.segmented import segmented
from curatio.session import written

# Boxes of one block; a block and its 12 sizes are one array of a task.
BLOCK = 4096
BOX = "array<struct<b:bigint,mean:double,m2:double,c:double>>"
LEVEL = "size bigint, boxes bigint, msq double"


def merged(b: np.ndarray, mean: np.ndarray, m2: np.ndarray, c: np.ndarray, size: int, n: int,
           block: int = BLOCK) -> tuple[list, tuple | None]:
    """Mean square residuals of a block's boxes at every size, and the block as one box if it is complete.

    ``b``: numbers of the boxes of ``size`` samples, ascending, within one block
    of a series of ``n``.  Sums of squares that rounding takes below 0 count as 0.
    """
    levels, number, boxes = [], int(b[0]) // block if len(b) else 0, block
    while len(b) and boxes >= 1:
        if boxes > 1 and size <= n // 4:
            spread = size * (size * size - 1) / 12.0
            msq = np.maximum(m2 - c * c / spread, 0.0) / size
            levels.append((size, len(b), float(msq.sum())))
        if boxes == 1:
            return levels, (number, float(mean[0]), float(m2[0]), float(c[0])) if len(b) == 1 else None
        # pairs (2i, 2i + 1); in a row of boxes from the block's start only the last can lack its partner
        k = len(b) // 2
        left, right = slice(0, 2 * k, 2), slice(1, 2 * k, 2)
        d = mean[right] - mean[left]
        m2 = m2[left] + m2[right] + d * d * size / 2
        c = c[left] + c[right] + d * (float(size) * size / 2)
        mean, b = (mean[left] + mean[right]) / 2, b[left] // 2
        size, boxes = 2 * size, boxes // 2
    return levels, None


def _merge(size: int, block: int):
    """Pandas UDF: a block's boxes of ``size`` samples and the series' length to its levels and the block as a box."""

    def run(it: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for boxes, length in it:
            out = []
            for flat, n in zip(boxes, length):
                a = np.asarray(flat, dtype=float).reshape(-1, 4)
                a = a[np.argsort(a[:, 0], kind="stable")]
                levels, whole = merged(a[:, 0].astype(np.int64), a[:, 1], a[:, 2], a[:, 3], size, int(n), block)
                out.append(([dict(zip(("size", "boxes", "msq"), x)) for x in levels],
                            None if whole is None else dict(zip(("b", "mean", "m2", "c"), whole))))
            yield pd.DataFrame(out, columns=["levels", "whole"])

    run.__annotations__ = {"it": Iterator[tuple[pd.Series, pd.Series]], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(run, f"levels array<struct<{LEVEL}>>, whole struct<b:bigint,mean:double,m2:double,c:double>")


def box_levels(boxes: DataFrame, keys: Sequence[str], size: int, block: int = BLOCK) -> DataFrame:
    """Rows ``(keys..., size, boxes, msq)`` from the smallest boxes ``(keys..., n, b, mean, m2, c)``.

    ``msq``: sum over ``boxes`` boxes of their mean square residual.  Records
    without a complete box have one row of NULLs.
    """
    kc = [as_col(k) for k in keys]
    found = None
    while True:
        row = F.array(F.col("b").cast("double"), F.col("mean"), F.col("m2"), F.col("c"))
        rows = boxes.groupBy(*kc, F.floor(F.col("b") / F.lit(block)).alias("__block")).agg(
            F.max("n").alias("n"), F.flatten(F.collect_list(F.when(F.col("c").isNotNull(), row))).alias("__boxes"))
        # one row a block: written, as its levels and its whole go separate ways
        got = written(rows.select(*kc, "n", _merge(size, block)("__boxes", "n").alias("g")).select(*kc, "n", "g.*"))
        rows = got.select(*kc, F.explode_outer("levels").alias("l")).select(*kc, "l.*")
        found = rows if found is None else found.unionByName(rows)
        boxes, size = got.where(F.col("whole").isNotNull()).select(*kc, "n", "whole.*"), size * block
        if boxes.isEmpty():
            return found


def dfa(df: DataFrame, keys: Sequence[str], order: Sequence[str], v: str = "v", min_box: int = 4,
        out: str = "dfa", rows: int | None = None, bounded: bool = False, block: int = BLOCK) -> DataFrame:
    """The scaling exponent ``out`` of every series.  ``rows``, ``bounded``: see ``segmented``."""
    size = 1 << (int(min_box).bit_length() - 1)
    x = as_col(v)
    kc = [as_col(k) for k in keys]
    seg = segmented(df.where(x.isNotNull()).select(*kc, *[as_col(o) for o in order if o not in keys], x.cast("double").alias("v__")),
                    keys, order, rows=rows, bounded=bounded, position="k__", length="n__", means={"v__": "m__"}, running={"v__": "cum__"})
    # profile y_k = sum_{j<=k} (x_j - m) = cumsum(x)_k - (k + 1) m
    y = (F.col("cum__") - (F.col("k__") + 1) * F.col("m__")).alias("y__")
    k = (F.col("k__") % F.lit(size)).cast("double").alias("k__")
    prof = seg.select(*kc, "n__", F.floor(F.col("k__") / F.lit(size)).alias("b"), k, y)
    full = F.count(F.lit(1)) == F.lit(size)
    boxes = prof.groupBy(*kc, "b").agg(
        F.max("n__").alias("n"), F.avg("y__").alias("mean"), F.regr_syy("y__", "k__").alias("m2"),
        F.when(full, F.regr_sxy("y__", "k__")).alias("c"))
    levels = box_levels(boxes, keys, size, block)
    per_n = levels.groupBy(*kc, "size").agg(F.sqrt(F.sum("msq") / F.sum("boxes")).alias("__fluct"))
    fluct = F.when(F.col("__fluct") > 0, F.col("__fluct"))
    return per_n.groupBy(*kc).agg(F.regr_slope(F.log(fluct), F.log(F.col("size").cast("double"))).alias(out))


def dfa_block(x: np.ndarray, min_box: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """``dfa`` of every row of ``x``, series of one length: exponents, and where they are not NULL."""
    w, n = x.shape
    size = 1 << (int(min_box).bit_length() - 1)
    total = np.cumsum(x, axis=1)
    y = total - np.arange(1.0, n + 1) * (total[:, -1:] / n)
    y = y[:, : n // size * size].reshape(w, -1, size)
    mean = y.sum(axis=2) / size
    # sample by sample, as Spark's regression aggregates
    avg, at, m2, c = np.zeros(mean.shape), 0.0, np.zeros(mean.shape), np.zeros(mean.shape)
    for k in range(size):
        delta = y[:, :, k] - avg
        part = delta / (k + 1.0)
        avg, at = avg + part, at + (k - at) / (k + 1.0)
        m2 = m2 + delta * (delta - part)
        c = c + delta * (k - at)
    logs, fluct = [], []
    while size <= n // 4:
        msq = np.maximum(m2 - c * c / (size * (size * size - 1) / 12.0), 0.0) / size
        logs.append(np.log(float(size)))
        fluct.append(np.sqrt(msq.sum(axis=1) / msq.shape[1]))
        # pairs of neighbours, as in ``merged``
        k = m2.shape[1] // 2 * 2
        left, right = np.s_[:, 0:k:2], np.s_[:, 1:k:2]
        d = mean[right] - mean[left]
        m2 = m2[left] + m2[right] + d * d * size / 2
        c = c[left] + c[right] + d * (float(size) * size / 2)
        mean = (mean[left] + mean[right]) / 2
        size *= 2
    if not logs:
        return np.zeros(w), np.zeros(w, dtype=bool)
    f = np.stack(fluct, axis=1)
    use = f > 0
    count = use.sum(axis=1)
    with np.errstate(all="ignore"):
        lx = np.where(use, np.array(logs), 0.0)
        ly = np.where(use, np.log(np.where(use, f, 1.0)), 0.0)
        dx = np.where(use, lx - (lx.sum(axis=1) / count)[:, None], 0.0)
        dy = np.where(use, ly - (ly.sum(axis=1) / count)[:, None], 0.0)
        return (dx * dy).sum(axis=1) / (dx * dx).sum(axis=1), count > 1
