"""Ordered-series operators inside one entity (a recording, a participant).

The work runs per (entity, chunk of rows) through
``curatio.operators.segmented`` - exact results, and an entity with a huge
share of the rows is spread over many tasks.  ``rows``: rows of a chunk, by
default as Spark's shuffle settings have it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatio.functions.expr import as_col
from curatio.operators.segmented import segmented


def lag_diff(df: DataFrame, part: Sequence[str], order: Sequence[str], col: str, out: str, lag: int = 1,
             rows: int | None = None) -> DataFrame:
    """``diff(x)``: x_i - x_{i-lag}; NULL for the first ``lag`` samples (H3)."""
    s = segmented(df, part, order, rows=rows, lags={col: [lag]})
    return s.withColumn(out, as_col(col) - F.col(f"lag{lag}_{col}")).drop(f"lag{lag}_{col}")


def running_sum(
    df: DataFrame, part: Sequence[str], order: Sequence[str], col: str, out: str, scale: Column | float | None = None,
    rows: int | None = None,
) -> DataFrame:
    """Cumulative sum (rectangle-rule integration when ``scale`` = 1/fs) (H4)."""
    s = segmented(df, part, order, rows=rows, running={col: "cum__"})
    v = F.col("cum__")
    if scale is not None:
        v = v * (scale if isinstance(scale, Column) else F.lit(scale))
    return s.withColumn(out, v).drop("cum__")


def with_position(df: DataFrame, part: Sequence[str], order: Sequence[str], pos: str = "i", n: str = "n",
                  rows: int | None = None, bounded: bool = False) -> DataFrame:
    """1-based sample position and series length."""
    s = segmented(df, part, order, rows=rows, bounded=bounded, position="p0__", length=n)
    return s.withColumn(pos, F.col("p0__") + 1).drop("p0__")


def percent_slice_means(
    df: DataFrame, part: Sequence[str], order: Sequence[str], col: str, fractions: Sequence[float],
    rows: int | None = None,
) -> DataFrame:
    """Mean of the first and last ``ceil(n * p)`` samples for every fraction p (H5).

    Output per entity: ``first_<pct>``, ``last_<pct>`` columns.
    """
    need = [c for c in dict.fromkeys([*part, *order, col, "__chunk"]) if c in df.columns]
    pos = with_position(df.where(as_col(col).isNotNull()).select(*need), part, order, "__i", "__n", rows)
    aggs = []
    for p in fractions:
        k = F.ceil(F.col("__n") * F.lit(p))
        tag = int(round(p * 100))
        aggs.append(F.avg(F.when(F.col("__i") <= k, as_col(col))).alias(f"first_{tag}"))
        aggs.append(F.avg(F.when(F.col("__i") > F.col("__n") - k, as_col(col))).alias(f"last_{tag}"))
    return pos.groupBy(*[as_col(p) for p in part]).agg(*aggs)


def fixed_windows(
    df: DataFrame, part: Sequence[str], order: Sequence[str], size: int, step: int | None = None, out: str = "window_id",
    rows: int | None = None, bounded: bool = False,
) -> DataFrame:
    """Assign samples to fixed-length windows within a series.

    ``step < size`` makes overlapping windows: a sample is emitted once per
    window that covers it (at most ``ceil(size/step)`` copies).  Windows start
    every ``step`` samples until the series is covered, so the last one may be
    shorter than ``size`` (as is window 0 of a series shorter than ``size``);
    with ``step <= size`` no sample is left out.
    """
    step = step or size
    pos = with_position(df, part, order, "__i", "__n", rows, bounded)
    i0 = F.col("__i") - 1
    # windows w with w*step <= i0 < w*step + size, up to the first that reaches the series' end
    last = F.greatest(F.ceil((F.col("__n") - F.lit(size)) / F.lit(step)), F.lit(0))
    lo = F.greatest(F.ceil((i0 - F.lit(size) + 1) / F.lit(step)), F.lit(0))
    hi = F.least(F.floor(i0 / F.lit(step)), last)
    ids = F.when(lo <= hi, F.sequence(lo.cast("int"), hi.cast("int"))).otherwise(F.array().cast("array<int>"))
    return pos.withColumn(out, F.explode(ids)).drop("__i", "__n", "__chunk")


def time_windows(df: DataFrame, ts: str, duration: str, slide: str | None = None, out: str = "window_id") -> DataFrame:
    """Fixed windows by time instead of sample count (H6): Spark's ``window`` on the
    timestamp, tumbling or sliding; a sample is emitted once per window that covers it.
    ``out`` is the window start (seconds since the epoch), usable as a window key.
    """
    w = F.window(F.col(ts).cast("timestamp"), duration, slide) if slide else F.window(F.col(ts).cast("timestamp"), duration)
    return df.withColumn("__w", w).withColumn(out, F.unix_seconds(F.col("__w.start"))).drop("__w")
