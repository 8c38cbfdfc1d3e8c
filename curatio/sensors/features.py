"""Native feature statistics of a series (tapping T, walking W, rest R, tremor X).

Input is long: ``(keys..., order, v)``.  Statistics split into
* algebraic ones (moments, extremes, energy, correlations): one ``groupBy``
  with partial aggregation;
* holistic ones (quantiles, mode): ``curatio.operators.quantiles``, or for
  ``bounded`` series Spark's exact ``percentile`` / ``mode`` aggregates, whose
  buffers hold one count per distinct value of a group;
* order-dependent ones (acf, zcr, tkeo, mobility, complexity, roughness):
  ``lag``/``lead`` over the record window, then an algebraic ``groupBy``.

Conventions for features the definitions leave open are listed in
SURVEY section 7.8 and repeated on each function.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatio.functions.expr import as_col
from curatio.operators.joins import same_keys
from curatio.operators.quantiles import group_mode, group_quantiles
from curatio.operators.segmented import segmented, spread


def _keys(keys: Sequence[str]) -> list[Column]:
    return [as_col(k) for k in keys]


MOMENTS = ["n", "mean", "sd", "skew", "kur", "min", "max", "range", "cv", "energy", "rmsmag"]
QUANTILES = ["q1", "median", "q3", "iqr", "mode"]
ORDERED = ["acf1", "acf2", "zcr", "tkeo", "mad", "mobility", "complexity", "rough", "rugo"]


def _moment_aggs(x: Column) -> list[Column]:
    return [
        F.count(x).alias("n"),
        F.avg(x).alias("mean"),
        F.stddev_samp(x).alias("sd"),
        F.skewness(x).alias("skew"),
        F.kurtosis(x).alias("kur"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
        (F.max(x) - F.min(x)).alias("range"),
        F.try_divide(F.stddev_samp(x), F.avg(x)).alias("cv"),
        F.sum(x * x).alias("energy"),
        F.sqrt(F.avg(x * x)).alias("rmsmag"),
    ]


def _quantile_aggs(x: Column, mode_digits: int | None = None) -> list[Column]:
    # + 0.0: -0.0 and 0.0 are one value
    m = x.cast("double") + F.lit(0.0) if mode_digits is None else F.bround(x, mode_digits)
    return [F.percentile(x, [0.25, 0.5, 0.75]).alias("__q"), F.mode(m, True).alias("mode")]


def _quantile_cols() -> list[Column]:
    q = F.col("__q")
    return [q[0].alias("q1"), q[1].alias("median"), q[2].alias("q3"), (q[2] - q[0]).alias("iqr")]


def _narrow(df: DataFrame, keys: Sequence[str], v: str) -> DataFrame:
    """Only the columns that a series' statistics read."""
    return df.select(*dict.fromkeys([*keys, v, *(c for c in ("__chunk",) if c in df.columns)]))


def _ordered_frame(df: DataFrame, keys: Sequence[str], order: Sequence[str], v: str, fs: float,
                   rows: int | None = None, bounded: bool = False) -> DataFrame:
    """Per-sample lag/lead terms from one segmented pass."""
    s = segmented(df, keys, order, rows=rows, bounded=bounded, means={v: "m__"}, lags={v: [1, 2]}, leads={v: [1, 2]})
    x = as_col(v)
    m = F.col("m__")
    prev, nxt, nxt2, prev2 = F.col(f"lag1_{v}"), F.col(f"lead1_{v}"), F.col(f"lead2_{v}"), F.col(f"lag2_{v}")
    return s.select(
        *_keys(keys),
        (x - m).alias("c"),
        (prev - m).alias("cp"),
        (nxt - m).alias("c1"),
        (nxt2 - m).alias("c2"),
        (x * x - prev * nxt).alias("tk"),
        ((x - prev) * F.lit(fs)).alias("d1"),
        ((x - F.lit(2.0) * prev + prev2) * F.lit(fs * fs)).alias("d2"),
        (x - prev).alias("dx"),
        x.alias("x"),
    )


def _ordered_aggs(fs: float) -> list[Column]:
    c = F.col("c")
    s0 = F.sum(c * c)
    return [
        F.try_divide(F.sum(c * F.col("c1")), s0).alias("acf1"),
        F.try_divide(F.sum(c * F.col("c2")), s0).alias("acf2"),
        F.try_divide(F.sum(F.when(c * F.col("cp") < 0, 1.0).otherwise(0.0)), F.count(F.col("cp"))).alias("zcr"),
        F.avg("tk").alias("tkeo"),
        F.avg(F.abs(c)).alias("mad"),
        F.sqrt(F.try_divide(F.var_samp("d1"), F.var_samp("x"))).alias("mobility"),
        F.sqrt(F.try_divide(F.var_samp("d2"), F.var_samp("d1"))).alias("complexity"),
        F.sum(F.col("d2") * F.col("d2") / F.lit(fs ** 4)).alias("rough"),
        F.sqrt(F.avg(F.col("dx") * F.col("dx"))).alias("rugo"),
    ]


def series_stats(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] | None = None,
    v: str = "v",
    fs: float = 1.0,
    groups: Sequence[str] = ("moments", "quantiles", "ordered"),
    rows: int | None = None,
    bounded: bool = False,
    mode_digits: int | None = None,
) -> DataFrame:
    """All requested statistics of every series in one aggregation.

    * ``moments``: n, mean, sd, skew (population), kur (excess, population),
      min, max, range, cv, energy, rmsmag (T1, T4-T8, T10, T11, W1, W2, W4, W5,
      W10, W14, X4, X12, X14, X15, X20, X22, X23, X26, X30);
    * ``quantiles``: q1, median, q3, iqr (type-7) and mode, smallest on a tie
      (T2, T3, W3, W6-W9, X11, X13, X17, X21) - exact;
    * ``ordered`` (needs ``order``): acf1/acf2 about the series mean (T13,
      W11); zcr, the share of successive pairs whose mean-centred values have
      opposite signs (W12; a zero is never a crossing); tkeo, mean of
      ``x_i^2 - x_{i-1} x_{i+1}`` over interior samples (T12, W15, X19); mad,
      mean absolute deviation from the mean (T9, as written); mobility
      sqrt(var(dx*fs)/var(x)) and complexity sqrt(var(d(dx*fs)*fs)/var(dx*fs))
      (X16, X2); rough, sum of squared second differences (X24, our
      convention); rugo, sqrt(mean squared first difference) (X25, ours).

    With ``ordered``, the lag terms come from one pass over the series and feed
    the same aggregate as the moments (no join); the series is written once
    (``segmented.spread``) and the quantiles read it from there.

    ``rows``: rows of a chunk, see ``segmented``.  ``bounded``: the series are
    short by construction (fixed windows) or by count (``by_length``), so plain windows and Spark's
    ``percentile``/``mode`` buffers in the same aggregate do.
    ``mode_digits`` takes the mode of the values rounded (half-even) to that
    many decimals.
    """
    want = set(groups)
    if "ordered" in want:
        if not order:
            raise ValueError("ordered statistics need an order")
        df = _narrow(df, [*keys, *order], v)
        if not bounded and "__chunk" not in df.columns:
            df = spread(df, [*keys, *order], rows)
        base, x = _ordered_frame(df, keys, order, v, fs, rows, bounded), F.col("x")
    else:
        base, x = df, as_col(v)
    aggs: list[Column] = []
    hist_q = "quantiles" in want and not bounded
    if "moments" in want:
        aggs += _moment_aggs(x)
    if "quantiles" in want and not hist_q:
        aggs += _quantile_aggs(x, mode_digits)
    if "ordered" in want:
        aggs += _ordered_aggs(fs)
    out = base.groupBy(*_keys(keys)).agg(*aggs) if aggs else None
    if "quantiles" in want and not hist_q:
        cols = [n for n in out.columns if n != "__q"]
        out = out.select(*[F.col(n) for n in cols], *_quantile_cols())
    if hist_q:
        q = group_quantiles(df, keys, v, [0.25, 0.5, 0.75], ["q1", "median", "q3"],
                            mode=None if mode_digits is not None else "mode", rows=rows)
        if mode_digits is not None:
            q = same_keys(q, group_mode(df, keys, v, mode_digits), keys)
        q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
        out = q if out is None else same_keys(out, q, keys)
    return out


def quartiles_sorted(s: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
    """Type-7 quartiles along axis 1 of the first ``n`` values of ``s``, sorted; ``n`` has no axis 1 and is 1 at least."""
    out = []
    for p in (0.25, 0.5, 0.75):
        at = p * (n - 1)
        lo, hi = np.floor(at), np.ceil(at)
        a, b = (np.take_along_axis(s, np.expand_dims(k.astype(int), 1), axis=1).squeeze(1) for k in (lo, hi))
        out.append(np.where(a == b, a, (hi - at) * a + (at - lo) * b))
    return out


def _modes(x: np.ndarray) -> np.ndarray:
    """The most frequent value of every row of ``x``, sorted by row; the smallest on a tie."""
    mode, equal = x[:, 0].copy(), x[:, 1:] == x[:, :-1]
    some = np.flatnonzero(equal.any(axis=1))
    run, best = np.ones(len(some), dtype=int), np.ones(len(some), dtype=int)
    for j in range(equal.shape[1]):
        run = np.where(equal[some, j], run + 1, 1)
        more = run > best
        best[more] = run[more]
        mode[some[more]] = x[some[more], j + 1]
    return mode


def sums(x: np.ndarray) -> np.ndarray:
    """Sum of every row, from left to right as in Spark's aggregates (numpy's own order differs in the last bits)."""
    return np.cumsum(x, axis=1)[:, -1]


def moments(x: np.ndarray, order: int = 2) -> list[np.ndarray]:
    """Sums of the 2nd to ``order``-th (4th at most) powers about the mean of every row.

    Sample by sample as Spark's aggregates do: exactly 0 for a flat row, and where little but
    rounding is left of the samples, the same of it.
    """
    avg, m2, m3, m4 = (np.zeros(len(x)) for _ in range(4))
    for j, v in enumerate(np.ascontiguousarray(x.T)):
        delta = v - avg
        part = delta / (j + 1.0)
        avg = avg + part
        m2 = m2 + delta * (delta - part)
        if order > 2:
            delta2, part2 = delta * delta, part * part
            m3 = m3 - 3.0 * part * m2 + delta * (delta2 - part2)
            m4 = m4 - 4.0 * part * m3 - 6.0 * part2 * m2 + delta * (delta * delta2 - part * part2)
    return [m2, m3, m4][: order - 1]


def variances(x: np.ndarray) -> np.ndarray:
    """Sample variance of every row, of two values or more."""
    return moments(x)[0] / (x.shape[1] - 1)


def series_block(x: np.ndarray, fs: float) -> dict[str, tuple[np.ndarray, np.ndarray | bool]]:
    """``series_stats`` of every row of ``x``, series of one length: values, and where they are not NULL.

    The statistics are those of the tremor table (no ``cv``, ``acf1``, ``acf2``, ``zcr`` and ``mad``).
    """
    n = x.shape[1]
    none = np.zeros(len(x)), False
    with np.errstate(all="ignore"):
        m2, m3, m4 = moments(x, 4)
        s = np.sort(x + 0.0, axis=1)  # + 0.0: -0.0 and 0.0 are one value
        q1, median, q3 = quartiles_sorted(s, np.full(len(x), n))
        low, high, square = s[:, 0], s[:, -1], x * x
        out = {"mean": (sums(x) / n, True), "median": (median, True), "min": (low, True), "max": (high, True),
               "sd": (np.sqrt(m2 / (n - 1)), True) if n > 1 else none,
               "skew": (np.sqrt(n) * m3 / np.sqrt(m2 * m2 * m2), m2 != 0), "kur": (n * m4 / (m2 * m2) - 3.0, m2 != 0),
               "q1": (q1, True), "q3": (q3, True), "iqr": (q3 - q1, True), "range": (high - low, True),
               "rmsmag": (np.sqrt(sums(square) / n), True), "energy": (sums(square), True), "mode": (_modes(s), True)}
        out |= dict.fromkeys(("tkeo", "mobility", "complexity", "rough", "rugo"), none)
        if n > 1:
            dx = x[:, 1:] - x[:, :-1]
            out["rugo"] = np.sqrt(sums(dx * dx) / (n - 1)), True
        if n > 2:
            v, v1 = m2 / (n - 1), variances(dx * fs)
            d2 = (x[:, 2:] - 2.0 * x[:, 1:-1] + x[:, :-2]) * (fs * fs)
            out["tkeo"] = sums(square[:, 1:-1] - x[:, :-2] * x[:, 2:]) / (n - 2), True
            out["mobility"] = np.sqrt(v1 / v), v != 0
            out["rough"] = sums(d2 * d2 / fs ** 4), True
        if n > 3:
            out["complexity"] = np.sqrt(variances(d2) / v1), v1 != 0
    return out


def moment_stats(df: DataFrame, keys: Sequence[str], v: str = "v") -> DataFrame:
    return series_stats(df, keys, v=v, groups=("moments",))


def quantile_stats(df: DataFrame, keys: Sequence[str], v: str = "v", bounded: bool = False) -> DataFrame:
    return series_stats(df, keys, v=v, groups=("quantiles",), bounded=bounded).select(*keys, *QUANTILES)


def order_stats(df: DataFrame, keys: Sequence[str], order: Sequence[str], v: str = "v",
                fs: float = 1.0, rows: int | None = None, bounded: bool = False) -> DataFrame:
    return series_stats(df, keys, order, v, fs, groups=("ordered",), rows=rows, bounded=bounded)


def fatigue(df: DataFrame, keys: Sequence[str], order: Sequence[str], v: str = "v",
            fractions: Sequence[float] = (0.1, 0.25, 0.5), rows: int | None = None) -> DataFrame:
    """mean(first p%) - mean(last p%) with ``ceil(n p)`` samples each."""
    from curatio.operators.windows import percent_slice_means

    s = percent_slice_means(df, keys, order, v, fractions, rows)
    cols = []
    for p in fractions:
        tag = int(round(p * 100))
        cols.append((F.col(f"first_{tag}") - F.col(f"last_{tag}")).alias(f"fatigue{tag}"))
    return s.select(*_keys(keys), *cols)


def correlation(x: str | Column, y: str | Column) -> Column:
    """Pearson correlation that is NULL (not an error) for a flat series."""
    a, b = as_col(x), as_col(y)
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def mode_of(v: str | Column) -> Column:
    return F.mode(as_col(v), True)
