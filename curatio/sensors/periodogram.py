"""Lomb-Scargle periodogram without a row per sample and frequency.

For every frequency f of a grid, the classical normalised periodogram

    P(f) = [ (sum y_c cos w(t-tau))^2 / sum cos^2 w(t-tau)
           + (sum y_c sin w(t-tau))^2 / sum sin^2 w(t-tau) ] / (2 var(y)),
    tan(2 w tau) = sum sin 2wt / sum cos 2wt,  w = 2 pi f,

needs three trigonometric sums over the samples: of e^{iwt}, of y_c e^{iwt} and
of e^{2iwt}.  The frequencies are f_min + k s, so e^{iwt} = e^{2 pi i f_min t}
e^{2 pi i k p} with the phase p = frac(s t): samples whose phases agree count
alike for all k.  The phase circle is cut into a fixed number of cells, many
times finer than the highest k.  Inside a cell e^{2 pi i k p} is a short power
series in the offset from the cell's middle, so the cell's samples enter only
through their moments: ``ORDER`` sums of each of the three terms.

1. per record: first time, mean, variance and count (partial aggregate);
2. times from the record's first and values from its mean, so that neither
   large times nor large means cost digits; moments by (record, cell), again a
   partial aggregate, additive: a record with a third of all rows leaves each
   map task with at most one row a cell;
3. a record's cells, whose number does not depend on its length, in one array;
   one batch of FFTs over the cells gives the sums at all frequencies.

Moments by cell pay for records with many more samples than cells.  ``bounded``
records, of so few samples that they fit a task as one array, have their sums taken
sample by sample instead (``sample_sums``): a row's two numbers are all
that is shuffled.

The power series' rest is below 1e-11 of the sums (``OVERSAMPLING``, ``ORDER``).
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatio.functions.expr import as_col
from curatio.operators.joins import same_keys

# Cells per frequency and terms of the power series: the series' argument stays
# below 2 pi / OVERSAMPLING, 0.2, and 0.2^8 / 8! is 6e-11; with the cells rounded
# up to a power of two and the offsets spread over the cell, sums are off by less.
OVERSAMPLING, ORDER = 32, 8


def cells_of(n_freq: int) -> int:
    """Number of phase cells: a power of two, at least ``OVERSAMPLING`` a frequency."""
    return 1 << max(6, math.ceil(math.log2(OVERSAMPLING * n_freq)))


def phase_moments(df: DataFrame, keys: Sequence[str], t: str, v: str, f_min: float, f_max: float,
                  n_freq: int) -> DataFrame:
    """Rows ``(keys..., n, var, cell, m)``: the moments of a record's samples in one phase cell.

    ``m`` holds, for each power of the offset, the sums of cos and sin of the
    base angle, of the centred value times these, and of cos and sin of twice
    the angle.
    """
    step = (f_max - f_min) / (n_freq - 1) if n_freq > 1 else 0.0
    cells = cells_of(n_freq)
    rows = df.where(as_col(v).isNotNull() & as_col(t).isNotNull()).select(
        *[as_col(k) for k in keys], as_col(t).cast("double").alias("t__"), as_col(v).cast("double").alias("y__")
    )
    whole = rows.groupBy(*[as_col(k) for k in keys]).agg(
        F.min("t__").alias("t0__"), F.avg("y__").alias("mu__"), F.var_samp("y__").alias("var"),
        F.count(F.lit(1)).alias("n"))
    rows = same_keys(rows, whole, keys)
    since = F.col("t__") - F.col("t0__")
    phase = since * F.lit(step)
    place = (phase - F.floor(phase)) * F.lit(float(cells))
    cell = F.least(F.floor(place), F.lit(cells - 1))
    base = since * F.lit(2 * math.pi * f_min)
    rows = rows.select(
        *[as_col(k) for k in keys], "n", "var", cell.cast("int").alias("cell"), (place - cell - F.lit(0.5)).alias("u__"),
        (F.col("y__") - F.col("mu__")).alias("y__"), F.cos(base).alias("c1__"), F.sin(base).alias("s1__"),
        F.cos(2 * base).alias("c2__"), F.sin(2 * base).alias("s2__"))
    terms = [F.col("c1__"), F.col("s1__"), F.col("y__") * F.col("c1__"), F.col("y__") * F.col("s1__"),
             F.col("c2__"), F.col("s2__")]
    # one column of powers of the offset, so that each power is computed once
    powers: list[Column] = [F.lit(1.0)]
    for _ in range(ORDER - 1):
        powers.append(powers[-1] * F.col("u__"))
    rows = rows.select("*", *[p.alias(f"p{j}__") for j, p in enumerate(powers)])
    sums = [F.sum(x * F.col(f"p{j}__")) for j in range(ORDER) for x in terms]
    return rows.groupBy(*[as_col(k) for k in keys], "n", "var", "cell").agg(F.array(*sums).alias("m"))


def trig_sums(moments: np.ndarray, cell: np.ndarray, cells: int, n_freq: int) -> np.ndarray:
    """Rows sum e^{iwt}, sum y e^{iwt} and sum e^{2iwt} at every frequency, from a record's (cell, order, 6) moments."""
    grid = np.zeros((ORDER, 3, cells), dtype=complex)
    m = moments.reshape(len(cell), ORDER, 3, 2)
    # a record's cells are distinct
    grid[:, :, cell] = np.moveaxis(m[..., 0] + 1j * m[..., 1], 0, -1)
    full = np.fft.ifft(grid, axis=-1) * cells
    out = np.zeros((3, n_freq), dtype=complex)
    for row, times in ((0, 1), (1, 1), (2, 2)):
        k = times * np.arange(n_freq)
        at = 2j * np.pi * k / cells
        term = np.exp(at / 2)
        for j in range(ORDER):
            out[row] += term * full[j, row, k]
            term = term * at / (j + 1)
    return out


def sample_sums(t: np.ndarray, y: np.ndarray, f_min: float, step: float, n_freq: int, piece: int = 4096) -> np.ndarray:
    """The three sums of ``trig_sums`` from the samples; memory for ``piece`` samples at all frequencies at a time."""
    out = np.zeros((3, n_freq), dtype=complex)
    for i in range(0, len(t), piece):
        s = t[i : i + piece]
        turn = np.empty((n_freq, len(s)), dtype=complex)
        turn[0] = np.exp(2j * np.pi * f_min * s)
        turn[1:] = np.exp(2j * np.pi * step * s)
        np.multiply.accumulate(turn, axis=0, out=turn)
        out[0] += turn.sum(axis=1)
        out[1] += turn @ y[i : i + piece]
        out[2] += np.einsum("kn,kn->k", turn, turn)
    return out


def power_from_sums(sums: np.ndarray, n: int, var: float) -> np.ndarray:
    """Normalised power at every frequency."""
    e1, ey, e2 = sums
    cc, ss, cs = (n + e2.real) / 2, (n - e2.real) / 2, e2.imag / 2
    tau = np.arctan2(2 * cs, cc - ss) / 2
    c, s = np.cos(tau), np.sin(tau)
    num_c, num_s = c * ey.real + s * ey.imag, c * ey.imag - s * ey.real
    den_c, den_s = c * c * cc + 2 * c * s * cs + s * s * ss, c * c * ss - 2 * c * s * cs + s * s * cc
    # a sum of squares that is nothing but rounding counts as 0
    parts = [np.divide(a * a, b, out=np.zeros(len(a)), where=b > 1e-9 * n) for a, b in ((num_c, den_c), (num_s, den_s))]
    return (parts[0] + parts[1]) / (2 * var)


def _whole_power(df: DataFrame, keys: Sequence[str], t: str, v: str, f_min: float, f_max: float, n_freq: int) -> DataFrame:
    """``lomb_scargle_power`` of records that fit a task: their samples as arrays of one row."""
    kc = [as_col(k) for k in keys]
    step = (f_max - f_min) / (n_freq - 1) if n_freq > 1 else 0.0

    def spectrum(it: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for times, values, first, mean, var in it:
            out = []
            for a, b, t0, mu, spread in zip(times, values, first, mean, var):
                if spread is None or not spread > 0:
                    out.append(None)
                    continue
                sums = sample_sums(np.asarray(a, dtype=float) - t0, np.asarray(b, dtype=float) - mu, f_min, step, n_freq)
                out.append(power_from_sums(sums, len(a), float(spread)).tolist())
            yield pd.Series(out, dtype=object)

    spectrum.__annotations__ = {"it": Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series, pd.Series]], "return": Iterator[pd.Series]}
    power = F.pandas_udf(spectrum, "array<double>")
    x, y = as_col(t).cast("double"), as_col(v).cast("double")
    per = df.where(as_col(v).isNotNull() & as_col(t).isNotNull()).groupBy(*kc).agg(
        F.collect_list(x).alias("__t"), F.collect_list(y).alias("__y"), F.min(x).alias("__t0"), F.avg(y).alias("__mu"),
        F.var_samp(y).alias("__v"))
    return per.select(*kc, power("__t", "__y", "__t0", "__mu", "__v").alias("power"))


def lomb_scargle_power(df: DataFrame, keys: Sequence[str], t: str, v: str, f_min: float, f_max: float,
                       n_freq: int, bounded: bool = False) -> DataFrame:
    """Per record ``power``: an array with the power at each frequency of the grid; NULL for a constant series."""
    if bounded:
        return _whole_power(df, keys, t, v, f_min, f_max, n_freq)
    kc = [as_col(k) for k in keys]
    cells = cells_of(n_freq)
    width = 1 + 6 * ORDER

    def spectrum(it: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for flat, n, var in it:
            out = []
            for a, count, spread in zip(flat, n, var):
                if spread is None or not spread > 0:
                    out.append(None)
                    continue
                m = np.asarray(a, dtype=float).reshape(-1, width)
                sums = trig_sums(m[:, 1:], m[:, 0].astype(int), cells, n_freq)
                out.append(power_from_sums(sums, int(count), float(spread)).tolist())
            yield pd.Series(out, dtype=object)

    spectrum.__annotations__ = {"it": Iterator[tuple[pd.Series, pd.Series, pd.Series]], "return": Iterator[pd.Series]}
    power = F.pandas_udf(spectrum, "array<double>")
    m = phase_moments(df, keys, t, v, f_min, f_max, n_freq)
    row = F.concat(F.array(F.col("cell").cast("double")), F.col("m"))
    per = m.groupBy(*kc).agg(F.flatten(F.collect_list(row)).alias("__m"), F.max("n").alias("__n"), F.max("var").alias("__v"))
    return per.select(*kc, power("__m", "__n", "__v").alias("power"))


def lomb_scargle_peak(df: DataFrame, keys: Sequence[str], t: str, v: str, f_min: float = 0.2,
                      f_max: float = 20.0, n_freq: int = 100, bounded: bool = False) -> DataFrame:
    """Per record: ``F0`` (frequency of the highest peak; lowest frequency on a
    tie) and ``P0`` (its power).  NULL for a constant series."""
    step = (f_max - f_min) / (n_freq - 1) if n_freq > 1 else 0.0
    p = lomb_scargle_power(df, keys, t, v, f_min, f_max, n_freq, bounded)
    at = F.array_position("power", F.array_max("power")) - 1
    return p.select(*[as_col(k) for k in keys],
                    F.when(F.col("power").isNotNull(), F.lit(f_min) + at * F.lit(step)).alias("F0"),
                    F.array_max("power").alias("P0"))
