"""Series derivation per recording.

A series is a long frame ``(record keys..., order, value columns)``.  Every
derivation goes through ``curatio.operators.segmented``: the record is
processed in chunks of rows (exact, skew-safe).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatio.functions.expr import as_col
from curatio.operators.segmented import segmented


def magnitude(cols: Sequence[str | Column]) -> Column:
    """Average acceleration ``AA = sqrt(X^2 + Y^2 + Z^2)``."""
    total = None
    for c in cols:
        sq = as_col(c) * as_col(c)
        total = sq if total is None else total + sq
    return F.sqrt(total)


def with_jerk(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str], out: str = "AJ",
              rows: int | None = None, bounded: bool = False) -> DataFrame:
    """Average jerk ``AJ = sqrt(dX^2 + dY^2 + dZ^2)``; NULL at the first sample."""
    s = segmented(df, keys, order, rows=rows, bounded=bounded, lags={c: [1] for c in cols})
    diffs = [as_col(c) - F.col(f"lag1_{c}") for c in cols]
    return s.withColumn(out, magnitude(diffs)).drop(*[f"lag1_{c}" for c in cols])


def tap_intervals(taps: DataFrame, keys: Sequence[str], order: Sequence[str], t: str = "t",
                  out: str = "interval", rows: int | None = None) -> DataFrame:
    """Time between successive taps of a record (N3); the first tap has none."""
    s = segmented(taps, keys, order, rows=rows, lags={t: [1]})
    return s.withColumn(out, as_col(t) - F.col(f"lag1_{t}")).drop(f"lag1_{t}").where(F.col(out).isNotNull())


def button_drift(taps: DataFrame, keys: Sequence[str], order: Sequence[str], button: str = "button",
                 x: str = "x", y: str = "y", out: str = "drift", rows: int | None = None) -> DataFrame:
    """Distance between successive hits on the same button (N4, our convention).

    Rows: one per hit after the first on each button; hits with no button
    (``'none'``) are not part of any drift series.
    """
    hits = taps.where(as_col(button) != F.lit("none"))
    s = segmented(hits, [*keys, button], order, rows=rows, lags={x: [1], y: [1]})
    dx = as_col(x) - F.col(f"lag1_{x}")
    dy = as_col(y) - F.col(f"lag1_{y}")
    return s.withColumn(out, F.sqrt(dx * dx + dy * dy)).drop(f"lag1_{x}", f"lag1_{y}").where(F.col(out).isNotNull())


def derived_axes(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, fs: float,
                 prefix: str = "u", rows: int | None = None, bounded: bool = False) -> DataFrame:
    """From acceleration ``ua``: velocity ``uv`` and displacement ``ud`` by running
    sums / fs, jerk ``uj`` = diff x fs (N5).  For a gyroscope series the same
    three give rotational displacement/acceleration (``uad``, ``uaa``)."""
    inv = 1.0 / fs
    s = segmented(df, keys, order, rows=rows, bounded=bounded, running={value: "cum__"}, running2={value: "cum2__"}, lags={value: [1]})
    return s.select(
        *[n for n in s.columns if n not in ("cum__", "cum2__", f"lag1_{value}")],
        (F.col("cum__") * F.lit(inv)).alias(f"{prefix}v"),
        (F.col("cum2__") * F.lit(inv * inv)).alias(f"{prefix}d"),
        ((as_col(value) - F.col(f"lag1_{value}")) * F.lit(fs)).alias(f"{prefix}j"),
    )


def acf_series(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, max_lag: int,
               out: str = "acf", rows: int | None = None) -> DataFrame:
    """Autocorrelation function for lags 0..max_lag.

    ``acf(k) = sum_i (x_i - m)(x_{i+k} - m) / sum_i (x_i - m)^2`` with the
    series mean ``m`` (biased estimator).  Rows ``(keys..., lag, acf)``.
    NULL for a constant series.
    """
    s = segmented(df, keys, order, rows=rows, means={value: "m__"}, leads={value: list(range(1, max_lag + 1))})
    m = F.col("m__")
    wide = s.select(
        *[as_col(k) for k in keys], (as_col(value) - m).alias("__c"),
        *[(F.col(f"lead{k}_{value}") - m).alias(f"__l{k}") for k in range(1, max_lag + 1)],
    )
    sums = [F.sum(F.col("__c") * F.col("__c")).alias("__s0")] + [
        F.sum(F.col("__c") * F.col(f"__l{k}")).alias(f"__s{k}") for k in range(1, max_lag + 1)
    ]
    agg = wide.groupBy(*[as_col(k) for k in keys]).agg(*sums)
    stack = ", ".join(f"{k}, try_divide(__s{k}, __s0)" for k in range(max_lag + 1))
    return agg.select(*[as_col(k) for k in keys], F.expr(f"stack({max_lag + 1}, {stack}) AS (lag, {out})"))


def sampling_rate(df: DataFrame, keys: Sequence[str], order: Sequence[str], t: str, rows: int | None = None, out: str = "fs") -> DataFrame:
    """Per record: 1 / median time step between successive samples (the default ``fs``).

    Steps come from the segmented lag, the median from the value histogram.
    NULL when a record has fewer than two samples or a zero median step.
    """
    from curatio.operators.quantiles import group_quantiles

    s = segmented(df, keys, order, rows=rows, lags={t: [1]})
    steps = s.select(*[as_col(k) for k in keys], (as_col(t) - F.col(f"lag1_{t}")).alias("dt__")).where(
        F.col("dt__").isNotNull())
    med = group_quantiles(steps, keys, "dt__", [0.5], ["m__"], mode=None, rows=rows)
    return med.select(*[as_col(k) for k in keys], F.try_divide(F.lit(1.0), F.col("m__")).alias(out))
