"""Frequency-domain and decomposition features.

The transforms themselves (FFT, autocorrelation by FFT, empirical mode
decomposition, empirical wavelet band split) have no DataFrame form.  The unit
of work is a *window* of a recording: a native aggregate packs its samples into
one array (the window's length is the bound), a pandas UDF maps arrays to
arrays in Arrow batches of bounded size, and the result is exploded natively,
so the keys never pass through Python and no task holds more than one batch.
(Outer, as Spark would filter empty results before a plain explode and run the
function a second time for that.)
Everything computed *from* a transform's output (spectral statistics, band
energies, entropies) is native.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curatio.functions.expr import as_col
from curatio.operators.joins import same_keys
from curatio.sensors.features import sums, variances

# --------------------------------------------------------------------------
# FFT spectrum
# --------------------------------------------------------------------------


def _packed(df: DataFrame, keys: Sequence[str], order: str, v: str) -> DataFrame:
    """One row a window: its keys and ``__x``, the non-NULL samples in ``order``."""
    sample = F.struct(F.col(order).alias("o"), F.col(v).cast("double").alias("x"))
    data = df.where(F.col(v).isNotNull()).groupBy(*[as_col(k) for k in keys])
    return data.agg(F.array_sort(F.collect_list(sample)).alias("__s")).select(
        *[as_col(k) for k in keys], F.transform("__s", lambda r: r["x"]).alias("__x"))


def _by_length(arrays: pd.Series, block) -> pd.Series:
    """Apply ``block`` (2-D array of windows of one length -> one row a window) to every length of a batch."""
    out: list = [None] * len(arrays)
    lens = np.array([len(a) for a in arrays], dtype=int)
    for n in np.unique(lens):
        sel = np.flatnonzero(lens == n)
        for i, row in zip(sel, block(np.stack([np.asarray(arrays.iloc[i], dtype=float) for i in sel]))):
            out[i] = row
    return pd.Series(out, dtype=object)


def _power(x: np.ndarray) -> np.ndarray:
    n = x.shape[1]
    if n < 2:
        return np.empty((len(x), 0))
    spec = np.fft.rfft(x - x.mean(axis=1, keepdims=True), axis=1)
    return (spec.real ** 2 + spec.imag ** 2) / n


def acf_block(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Autocorrelation functions of the rows, and which rows are not flat (flat ones have none)."""
    n = x.shape[1]
    spec = np.fft.rfft(x - x.mean(axis=1, keepdims=True), n=2 * n, axis=1)
    ac = np.fft.irfft(spec.real ** 2 + spec.imag ** 2, n=2 * n, axis=1)[:, :n]
    some = ac[:, 0] > 1e-300
    return ac / np.where(some, ac[:, 0], 1.0)[:, None], some


def _acf(x: np.ndarray) -> list:
    return [a.tolist() if some else [None] * len(a) for a, some in zip(*acf_block(x))]


def spectrum(df: DataFrame, keys: Sequence[str], order: str, v: str, fs: float) -> DataFrame:
    """One-sided power spectrum of the mean-centred series per window.

    Rows ``(keys..., bin, freq, power)``, ``power = |rfft|^2 / n``; bin 0 is DC.
    Windows of equal length in a batch are transformed in one 2-D
    ``numpy.fft.rfft`` call; a window of one sample has no rows.
    """

    @F.pandas_udf("array<double>")
    def power(x: pd.Series) -> pd.Series:
        return _by_length(x, _power)

    kc = [as_col(k) for k in keys]
    got = _packed(df, keys, order, v).select(*kc, F.size("__x").alias("__n"), power("__x").alias("__p"))
    rows = got.select(*kc, "__n", F.posexplode_outer("__p").alias("bin", "power")).where(F.col("bin").isNotNull())
    return rows.select(*kc, "bin", (F.col("bin") * (F.lit(1.0) / (F.col("__n") * F.lit(1.0 / fs)))).alias("freq"), "power")


def acf_windows(df: DataFrame, keys: Sequence[str], order: str, v: str) -> DataFrame:
    """Autocorrelation function of every window, all lags (N6, the ``...acf`` axes).

    Rows ``(keys..., lag, acf)`` with ``acf(k) = sum (x_i - m)(x_{i+k} - m) /
    sum (x_i - m)^2`` (biased), computed per window through a zero-padded FFT
    (O(n log n) instead of O(n^2) lag products); NULL for a flat window.
    """

    @F.pandas_udf("array<double>")
    def acf(x: pd.Series) -> pd.Series:
        return _by_length(x, _acf)

    kc = [as_col(k) for k in keys]
    got = _packed(df, keys, order, v).select(*kc, acf("__x").alias("__a"))
    return got.select(*kc, F.posexplode_outer("__a").alias("lag", "acf")).where(F.col("lag").isNotNull())


def spectral_stats(spec: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Native statistics of a spectrum (DC bin excluded):
    ``cent`` centroid, ``mn`` mean power, ``mod`` peak frequency, ``sem``
    sd/sqrt(n) of the power, ``sfm`` flatness, ``sh`` Shannon entropy of the
    normalised spectrum (X1, X15, X18, X27, X28, X29)."""
    s = spec.where(F.col("bin") > 0)
    tot = F.sum("power")
    agg = s.groupBy(*[as_col(k) for k in keys]).agg(
        F.try_divide(F.sum(F.col("freq") * F.col("power")), tot).alias("cent"),
        F.avg("power").alias("mn"),
        F.max_by("freq", F.struct(F.col("power"), -F.col("bin"))).alias("mod"),
        (F.stddev_samp("power") / F.sqrt(F.count(F.lit(1)))).alias("sem"),
        F.try_divide(F.exp(F.avg(F.when(F.col("power") > 0, F.log("power")))),
                     F.avg(F.when(F.col("power") > 0, F.col("power")))).alias("sfm"),
        tot.alias("__tot"),
        F.sum(F.when(F.col("power") > 0, F.col("power") * F.log("power"))).alias("__plogp"),
    )
    # sh = -sum q ln q with q = p / T  =  ln T - (sum p ln p) / T
    sh = F.when(F.col("__tot") > 0, F.log("__tot") - F.col("__plogp") / F.col("__tot"))
    return agg.withColumn("sh", sh).drop("__tot", "__plogp")


def band_energies(spec: DataFrame, keys: Sequence[str], band_width: float = 1.0, n_bands: int = 25) -> DataFrame:
    """``EnergyBandN``: power summed over equal-width bands [N*w, (N+1)*w).

    ``EnergyBandAbove`` holds the power from the last band's end up, so that
    the bands add up to the whole.  Rows are pivoted with the explicit band
    list (no discovery job)."""
    band = F.floor(F.col("freq") / F.lit(band_width)).cast("int")
    names = [f"EnergyBand{i}" for i in range(n_bands)] + ["EnergyBandAbove"]
    place = F.when(band < n_bands, band.cast("string")).otherwise("Above")
    s = spec.withColumn("band_name", F.concat(F.lit("EnergyBand"), place))
    return s.groupBy(*[as_col(k) for k in keys]).pivot("band_name", names).agg(F.sum("power"))


def spectral_block(power: np.ndarray, n: int, fs: float, band_width: float,
                   n_bands: int) -> dict[str, tuple[np.ndarray, np.ndarray | bool]]:
    """``spectral_stats`` and ``band_energies`` of every row of ``power``, spectra of series of ``n`` samples."""
    w, bins = power.shape
    none = np.zeros(w), False
    out: dict = dict.fromkeys(("cent", "mn", "mod", "sem", "sfm", "sh"), none)
    out |= dict.fromkeys([f"EnergyBand{b}" for b in range(n_bands)] + ["EnergyBandAbove"], none)
    if not bins:
        return out
    freq = np.arange(bins) * (1.0 / (n * (1.0 / fs)))
    band = np.minimum(np.floor(freq / band_width), n_bands).astype(int)
    for b in np.unique(band):
        out[f"EnergyBand{b}" if b < n_bands else "EnergyBandAbove"] = sums(power[:, band == b]), True
    p, f, k = power[:, 1:], freq[1:], bins - 1
    if not k:
        return out
    with np.errstate(all="ignore"):
        total, some = sums(p), p > 0
        logs, count = np.log(np.where(some, p, 1.0)), some.sum(axis=1)
        mean = sums(np.where(some, p, 0.0)) / count
        out["cent"] = sums(f * p) / total, total != 0
        out["mn"] = total / k, True
        out["mod"] = f[p.argmax(axis=1)], True
        if k > 1:
            out["sem"] = np.sqrt(variances(p)) / np.sqrt(k), True
        out["sfm"] = np.exp(sums(logs) / count) / mean, count > 0
        out["sh"] = np.log(total) - sums(p * logs) / total, total > 0
    return out


# --------------------------------------------------------------------------
# Empirical mode decomposition (Huang et al. 1998)
# --------------------------------------------------------------------------


def tridiagonal(lower: np.ndarray, diag: np.ndarray, upper: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Solutions of many tridiagonal systems, one a row, by parallel cyclic reduction.

    Each step eliminates the neighbours at twice the distance in all equations
    at once, so the number of steps is the logarithm of the systems' size.
    ``lower[:, 0]`` and ``upper[:, -1]`` must be 0.  For diagonally dominant systems.
    """
    def moved(x: np.ndarray, by: int, fill: float) -> np.ndarray:
        out = np.full_like(x, fill)
        if by > 0:
            out[:, by:] = x[:, :-by]
        else:
            out[:, :by] = x[:, -by:]
        return out

    step = 1
    while step < diag.shape[1]:
        left, beyond = -lower / moved(diag, step, 1.0), -upper / moved(diag, -step, 1.0)
        diag, right, lower, upper = (
            diag + left * moved(upper, step, 0.0) + beyond * moved(lower, -step, 0.0),
            right + left * moved(right, step, 0.0) + beyond * moved(right, -step, 0.0),
            left * moved(lower, step, 0.0), beyond * moved(upper, -step, 0.0))
        step *= 2
    return right / diag


def envelopes(x: np.ndarray, knots: np.ndarray) -> np.ndarray:
    """Natural cubic spline of every row through its values at ``knots`` (a mask) at every sample.

    The first and the last sample become knots with the value of the nearest
    one.  Rows have different numbers of knots: the systems are padded with
    equations of their own that say 0 = 0.  A row needs two knots or more
    between its ends.
    """
    w, n = x.shape
    count = knots.sum(axis=1) + 2
    size = int(count.max())
    row, at = np.nonzero(knots)
    start = np.concatenate(([0], np.cumsum(count - 2)[:-1]))
    place = np.arange(len(at)) - start[row] + 1
    xk = np.zeros((w, size))
    xk[row, place] = at
    yk = np.zeros((w, size))
    yk[row, place] = x[row, at]
    yk[:, 0] = yk[:, 1]
    every = np.arange(w)
    xk[every, count - 1] = n - 1
    yk[every, count - 1] = yk[every, count - 2]
    inside = np.arange(size - 1) < (count - 1)[:, None]  # intervals that exist
    h = np.where(inside, np.diff(xk, axis=1), 1.0)
    slope = np.where(inside, np.diff(yk, axis=1) / h, 0.0)
    free = np.zeros((w, size), dtype=bool)  # knots between two intervals
    free[:, 1:-1] = inside[:, 1:]
    diag, lower, upper, right = np.ones((w, size)), np.zeros((w, size)), np.zeros((w, size)), np.zeros((w, size))
    diag[:, 1:-1] = np.where(free[:, 1:-1], 2 * (h[:, :-1] + h[:, 1:]), 1.0)
    lower[:, 1:-1] = np.where(free[:, 1:-1] & free[:, :-2], h[:, :-1], 0.0)
    upper[:, 1:-1] = np.where(free[:, 1:-1] & free[:, 2:], h[:, 1:], 0.0)
    right[:, 1:-1] = np.where(free[:, 1:-1], 3 * (slope[:, 1:] - slope[:, :-1]), 0.0)
    c = tridiagonal(lower, diag, upper, right)
    b = slope - h * (c[:, 1:] + 2 * c[:, :-1]) / 3
    d = np.diff(c, axis=1) / (3 * h)
    # interval of each sample: how many knots lie at or before it
    seen = 1 + np.cumsum(knots, axis=1)
    k = np.minimum(seen, (count - 1)[:, None]) - 1
    take = lambda a: np.take_along_axis(a, k, axis=1)
    dx = np.arange(n) - take(xk)
    return take(yk) + dx * (take(b) + dx * (take(c) + dx * take(d)))


def extrema(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Masks of strict local maxima and minima of every row."""
    up, down = np.zeros(x.shape, dtype=bool), np.zeros(x.shape, dtype=bool)
    d = np.diff(x, axis=1)
    up[:, 1:-1] = (d[:, :-1] > 0) & (d[:, 1:] < 0)
    down[:, 1:-1] = (d[:, :-1] < 0) & (d[:, 1:] > 0)
    return up, down


def _oscillates(x: np.ndarray) -> np.ndarray:
    """Rows with at least two maxima and two minima."""
    up, down = extrema(x)
    return (up.sum(axis=1) >= 2) & (down.sum(axis=1) >= 2)


def sift(x: np.ndarray, tol: float, max_sift: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One mode of every row, the rounds it took, and whether it converged.

    A row leaves the work when the normalised squared change of a round is below
    ``tol`` or it has too few extrema for envelopes; rows that still change
    after ``max_sift`` rounds have not converged.
    """
    mode, rounds, converged = x.copy(), np.zeros(len(x), dtype=int), np.zeros(len(x), dtype=bool)
    active = np.arange(len(x))
    for _ in range(max_sift):
        h = mode[active]
        up, down = extrema(h)
        ok = (up.sum(axis=1) >= 2) & (down.sum(axis=1) >= 2)
        converged[active[~ok]] = True
        active, h, up, down = active[ok], h[ok], up[ok], down[ok]
        if not len(active):
            break
        new = h - (envelopes(h, up) + envelopes(h, down)) / 2
        change = ((h - new) ** 2).sum(axis=1) / np.maximum((h ** 2).sum(axis=1), 1e-300)
        mode[active] = new
        rounds[active] += 1
        done = change < tol
        converged[active[done]] = True
        active = active[~done]
    return mode, rounds, converged


def emd_block(residue: np.ndarray, max_imf: int | None = None, tol: float = 0.3,
              max_sift: int = 1000) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Mode by mode: the rows that have it, the mode of each, its rounds and convergence; ``residue`` loses the modes."""
    for _ in range(residue.shape[1] if max_imf is None else max_imf):
        active = np.flatnonzero(_oscillates(residue)) if residue.shape[1] > 2 else np.empty(0, dtype=int)
        if not len(active):
            return
        mode, took, ended = sift(residue[active], tol, max_sift)
        residue[active] -= mode
        yield active, mode, took, ended


def emd_batch(x: np.ndarray, max_imf: int | None = None, tol: float = 0.3,
              max_sift: int = 1000) -> tuple[list[list[np.ndarray]], list[list[int]], list[list[bool]], np.ndarray]:
    """Modes, rounds and convergence of every row, and the residues.

    A row's decomposition ends when its residue has fewer than two maxima or
    minima, or after ``max_imf`` modes if that is given.
    """
    residue = x.astype(float).copy()
    modes: list[list[np.ndarray]] = [[] for _ in x]
    rounds: list[list[int]] = [[] for _ in x]
    converged: list[list[bool]] = [[] for _ in x]
    for active, mode, took, ended in emd_block(residue, max_imf, tol, max_sift):
        for i, m, r, c in zip(active, mode, took, ended):
            modes[i].append(m)
            rounds[i].append(int(r))
            converged[i].append(bool(c))
    return modes, rounds, converged, residue


def emd_imfs(x: np.ndarray, max_imf: int | None = None, tol: float = 0.3, max_sift: int = 1000) -> list[np.ndarray]:
    """Intrinsic mode functions of one series; the residue is ``x`` less their sum."""
    return emd_batch(np.asarray(x, dtype=float)[None, :], max_imf, tol, max_sift)[0][0]


def emd(df: DataFrame, keys: Sequence[str], order: str, v: str, max_imf: int | None = None,
        residue: bool = False) -> DataFrame:
    """EMD per window (N10): rows ``(keys..., imf, i, value, rounds, converged)``; ``imf`` is 1-based.

    ``rounds`` of sifting the mode took, and whether they ``converged`` before
    the limit of ``emd_batch``.  With ``residue``, rows of ``imf`` 0 hold what
    the modes leave, so that the values of a sample add up to the input.
    """

    def block(x: np.ndarray) -> list:
        modes, rounds, converged, rest = emd_batch(x, max_imf)
        return [[(r.tolist(), 0, True), *zip((m.tolist() for m in ms), n, c)] for ms, n, c, r in zip(modes, rounds, converged, rest)]

    fields = ("value", "rounds", "converged")

    @F.pandas_udf("array<struct<value:array<double>,rounds:int,converged:boolean>>")
    def decompose(batch: pd.Series) -> pd.Series:
        return _by_length(batch, lambda x: [[dict(zip(fields, m)) for m in row] for row in block(x)])

    kc = [as_col(k) for k in keys]
    got = _packed(df, keys, order, v).select(*kc, decompose("__x").alias("__m"))
    # a window has its residue at least, so none is empty
    rows = got.select(*kc, F.posexplode_outer("__m").alias("imf", "__v"))
    rows = rows if residue else rows.where(F.col("imf") > 0)
    return rows.select(*kc, "imf", F.posexplode("__v.value").alias("i", "value"), F.col("__v.rounds").alias("rounds"),
                       F.col("__v.converged").alias("converged"))


# --------------------------------------------------------------------------
# Empirical wavelet transform band energies (Gilles 2013)
# --------------------------------------------------------------------------


def _beta(x: np.ndarray) -> np.ndarray:
    """Meyer transition polynomial on [0, 1]: x^4 (35 - 84x + 70x^2 - 20x^3)."""
    x = np.clip(x, 0.0, 1.0)
    return x ** 4 * (35 - 84 * x + 70 * x ** 2 - 20 * x ** 3)


def meyer_filter_bank(omega: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Squared responses of the empirical-wavelet filters on ``omega`` in [0, pi].

    Gilles (2013): a scaling function below the first boundary and one
    wavelet per segment, with Meyer (``_beta``) transitions of relative width
    gamma around each boundary; gamma = 0.9 x the largest value that keeps
    neighbouring transitions apart.  The squared responses sum to 1 at every
    frequency (tight frame), so component energies add up to the total.
    Rows: one per component (len(bounds) + 1).
    """
    w = np.abs(omega)
    edges = np.concatenate([[0.0], bounds, [np.pi]])
    ratios = [(edges[i + 1] - edges[i]) / (edges[i + 1] + edges[i]) for i in range(1, len(edges) - 1)]
    gamma = 0.9 * min(ratios) if ratios else 0.0
    out = []

    def rise(wn):  # 0 -> 1 across the transition around wn (sin part)
        if gamma == 0:
            return (w >= wn).astype(float)
        return np.where(w <= (1 - gamma) * wn, 0.0, np.where(
            w >= (1 + gamma) * wn, 1.0, np.sin(np.pi / 2 * _beta((w - (1 - gamma) * wn) / (2 * gamma * wn))) ** 2))

    rises = [rise(b) for b in bounds]
    # component n covers [bounds[n-1], bounds[n]]: rise at the lower edge x (1 - rise at the upper edge)
    for n in range(len(bounds) + 1):
        lower = rises[n - 1] if n > 0 else np.ones_like(w)
        upper = (1.0 - rises[n]) if n < len(bounds) else np.ones_like(w)
        out.append(lower * upper)
    return np.array(out)


def ewt_band_energies_np(x: np.ndarray, n_bands: int = 5) -> np.ndarray:
    """Energies of the EWT components of ``x``.

    Boundaries lie midway between the ``n_bands`` largest local maxima of the
    magnitude spectrum; the components are the Meyer-type empirical wavelet
    filters over those boundaries (``meyer_filter_bank``), so by Parseval a
    component's energy is the spectrum power weighted by its squared response.
    """
    x = x - x.mean()
    spec = np.fft.rfft(x)
    mag = np.abs(spec)
    p = mag ** 2
    if len(mag) < 3:
        return np.array([p.sum()])
    peaks = np.where((mag[1:-1] > mag[:-2]) & (mag[1:-1] >= mag[2:]))[0] + 1
    if len(peaks) < 2:
        return np.array([p.sum()])
    top = np.sort(peaks[np.argsort(-mag[peaks], kind="stable")[:n_bands]])
    omega = np.linspace(0.0, np.pi, len(p)) if len(x) % 2 == 0 else 2 * np.pi * np.arange(len(p)) / len(x)
    bounds = (omega[top[:-1]] + omega[top[1:]]) / 2
    return meyer_filter_bank(omega, bounds) @ p


def ewt_block(x: np.ndarray, n_bands: int = 5) -> list[tuple[np.ndarray, np.ndarray]]:
    """``ewt_band_energies_np`` of every row of ``x``, by number of components: row numbers and their energies."""
    w, n = x.shape
    if n < 2:
        return []
    mag = np.abs(np.fft.rfft(x - x.mean(axis=1, keepdims=True), axis=1))
    p = mag ** 2
    peak = np.zeros(mag.shape, dtype=bool)
    peak[:, 1:-1] = (mag[:, 1:-1] > mag[:, :-2]) & (mag[:, 1:-1] >= mag[:, 2:])
    count = np.minimum(peak.sum(axis=1), n_bands)
    few = np.flatnonzero(count < 2)
    out = [(few, p[few].sum(axis=1, keepdims=True))] if len(few) else []
    omega = np.linspace(0.0, np.pi, p.shape[1]) if n % 2 == 0 else 2 * np.pi * np.arange(p.shape[1]) / n
    first = np.argsort(np.where(peak, -mag, np.inf), axis=1, kind="stable")[:, :n_bands]
    for k in range(2, n_bands + 1):
        rows = np.flatnonzero(count == k)
        if not len(rows):
            continue
        at = omega[np.sort(first[rows, :k], axis=1)]
        bounds = (at[:, :-1] + at[:, 1:]) / 2
        upper = np.concatenate([bounds[:, 1:], np.full((len(rows), 1), np.pi)], axis=1)
        gamma = (0.9 * ((upper - bounds) / (upper + bounds)).min(axis=1))[:, None]
        energies, low = np.empty((len(rows), k)), 1.0
        for j in range(k):
            if j < k - 1:
                wn = bounds[:, j : j + 1]
                high = np.where(omega <= (1 - gamma) * wn, 0.0, np.where(
                    omega >= (1 + gamma) * wn, 1.0, np.sin(np.pi / 2 * _beta((omega - (1 - gamma) * wn) / (2 * gamma * wn))) ** 2))
            energies[:, j] = ((low * (1.0 - high) if j < k - 1 else low) * p[rows]).sum(axis=1)
            low = high
        out.append((rows, energies))
    return out


def entropy_block(energies: np.ndarray, q: float = 2.0, perm_order: int = 3) -> dict[str, tuple[np.ndarray, np.ndarray | bool]]:
    """``energy_entropies`` of every row of ``energies``, rows of one number of bands."""
    total = sums(energies)
    with np.errstate(all="ignore"):
        p = energies / total[:, None]
        power = sums(p ** q)
        out = {"shannonEnt": -sums(np.where(p > 0, p * np.log(np.where(p > 0, p, 1.0)), 0.0)), "simpsonEnt": 1.0 - sums(p * p),
               "renyiEnt": np.log(power) / (1.0 - q), "tsallisEnt": (1.0 - power) / (q - 1.0)}
    found = {name: (v, total != 0) for name, v in out.items()}
    m = energies.shape[1] - perm_order + 1
    if m < 1:
        return found | {"permEnt": (np.zeros(len(energies)), False)}
    leads = [energies[:, j : j + m] for j in range(perm_order)]
    pattern = np.zeros((len(energies), m), dtype=int)
    for a in range(perm_order):
        rank = sum((leads[b] < leads[a]) | ((leads[b] == leads[a]) & (b < a)) for b in range(perm_order) if b != a)
        pattern = pattern * perm_order + rank
    s = np.zeros(len(energies))
    for code in np.unique(pattern):
        pp = (pattern == code).sum(axis=1) / m
        s += pp * np.log(np.where(pp > 0, pp, 1.0))
    return found | {"permEnt": (-s / math.log(math.factorial(perm_order)), True)}


def ewt_energies(df: DataFrame, keys: Sequence[str], order: str, v: str, n_bands: int = 5) -> DataFrame:
    """Rows ``(keys..., band, energy)`` per window of two samples or more."""

    @F.pandas_udf("array<double>")
    def energies(batch: pd.Series) -> pd.Series:
        return pd.Series([ewt_band_energies_np(np.asarray(a, dtype=float), n_bands) if len(a) > 1 else [] for a in batch],
                         dtype=object)

    kc = [as_col(k) for k in keys]
    got = _packed(df, keys, order, v).select(*kc, energies("__x").alias("__e"))
    return got.select(*kc, F.posexplode_outer("__e").alias("band", "energy")).where(F.col("band").isNotNull())


def energy_entropies(energies: DataFrame, keys: Sequence[str], q: float = 2.0, perm_order: int = 3) -> DataFrame:
    """Entropies of normalised band energies (X6-X10), all native.

    ``shannonEnt`` -sum p ln p; ``simpsonEnt`` 1 - sum p^2; ``renyiEnt``
    ln(sum p^q)/(1-q); ``tsallisEnt`` (1 - sum p^q)/(q-1); ``permEnt``
    permutation entropy (order ``perm_order``, delay 1) of the energy
    sequence, ties broken by position, normalised by ln(order!).
    """
    part = Window.partitionBy(*[as_col(k) for k in keys])
    w = part.orderBy("band")
    e = energies.withColumn("p", F.try_divide(F.col("energy"), F.sum("energy").over(part)))
    leads = [F.lead("energy", j).over(w) for j in range(perm_order)]
    # ordinal pattern: rank of each element within the embedding vector
    ranks = []
    for a in range(perm_order):
        r = F.lit(0)
        for b in range(perm_order):
            if b == a:
                continue
            less = (leads[b] < leads[a]) | ((leads[b] == leads[a]) & F.lit(b < a))
            r = r + F.when(less, 1).otherwise(0)
        ranks.append(r.cast("string"))
    pattern = F.when(leads[-1].isNotNull(), F.concat_ws("", *ranks))
    e = e.withColumn("pattern", pattern)
    base = e.groupBy(*[as_col(k) for k in keys]).agg(
        (-F.sum(F.when(F.col("p") > 0, F.col("p") * F.log("p")))).alias("shannonEnt"),
        (F.lit(1.0) - F.sum(F.col("p") * F.col("p"))).alias("simpsonEnt"),
        (F.log(F.sum(F.pow("p", q))) / F.lit(1.0 - q)).alias("renyiEnt"),
        ((F.lit(1.0) - F.sum(F.pow("p", q))) / F.lit(q - 1.0)).alias("tsallisEnt"),
    )
    pats = e.where(F.col("pattern").isNotNull()).groupBy(*[as_col(k) for k in keys], "pattern").agg(
        F.count(F.lit(1)).alias("cnt")
    )
    tot = Window.partitionBy(*[as_col(k) for k in keys])
    perm = pats.withColumn("pp", F.col("cnt") / F.sum("cnt").over(tot)).groupBy(*[as_col(k) for k in keys]).agg(
        (-F.sum(F.col("pp") * F.log("pp")) / F.lit(math.log(math.factorial(perm_order)))).alias("permEnt")
    )
    return same_keys(base, perm, keys)
