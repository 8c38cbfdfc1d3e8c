"""The tremor feature table: ``<feature>.<domain>.<IMF>.<stat>_<axis>_<sensor>[.STAT]``.

Pipeline (all keyed by recording; Python only inside the grouped transforms):

1. derived axes from the recorded series - accelerometer ``ua`` -> ``uv``,
   ``ud`` (running sums / fs), ``uj`` (difference x fs); gyroscope ``uav``
   -> ``uad``, ``uaa`` - through the segmented series primitive;
2. fixed windows (``window`` samples, ``step`` apart) per recording;
3. the ACF axis (``uaacf`` / ``uavacf``) per window by FFT;
4. EMD of every (window, axis) series -> IMF1..IMFn, all of them unless ``n_imf``
   says otherwise; beside them stays the series itself, whose names have no IMF part;
   all that is written once, and every statistic reads it from there;
5. per (window, axis, IMF): time-domain statistics (``tm``: mean, median/md,
   mn = min, mx, sd, skewness/skew, kurtosis/kurt, Q25, Q75, IQR, range,
   rmsmag, energy, mode, mtkeo, mobility, complexity, rough, rugo, dfa) and
   frequency-domain statistics of its spectrum (``fr``: cent, mn = mean
   power, mod, sem, sfm, sh, EnergyBandN) plus the EWT energy entropies;
6. ``<stat>``: median (md) and IQR (iqr) across the windows of a recording;
   optional ``[STAT]``: md / IQR across the recordings of an individual
   (skew-safe histogram quantiles).

Recordings that fit a task (``by_length``) are shuffled once, by recording: the windows of
an axis become arrays in one row, and one function over Arrow batches does steps 3 to 6
on blocks of series of one length (the ``..._block`` functions, beside the row operators they equal), so that
neither modes nor window values leave it and nothing is written between.  Longer recordings
are spread by rows, and their window values take the histogram quantiles.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatio.operators.joins import same_keys
from curatio.operators.quantiles import group_quantiles
from curatio.operators.reshape import unpivot
from curatio.operators.segmented import by_length, spread
from curatio.operators.windows import fixed_windows
from curatio.sensors import features as FT
from curatio.sensors import series as SR
from curatio.sensors import spectral as SP
from curatio.sensors.fractal import dfa, dfa_block
from curatio.session import written

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# ---------------------------------------------------------------------------
# Axis names per sensor: recorded series, integral(s), derivative, acf axis.
ACCEL_AXES = {"value": "ua", "integral": "uv", "integral2": "ud", "derivative": "uj", "acf": "uaacf"}
GYRO_AXES = {"value": "uav", "integral": "uad", "derivative": "uaa", "acf": "uavacf"}
# Time-domain features (our statistic -> dictionary names; two names for one statistic are both emitted).
TM_FEATURES = {
    "mean": ["mean"], "median": ["md", "median"], "min": ["mn"], "max": ["mx"], "sd": ["sd"],
    "skew": ["skew", "skewness"], "kur": ["kurt", "kurtosis"], "q1": ["Q25"], "q3": ["Q75"], "iqr": ["IQR"],
    "range": ["range"], "rmsmag": ["rmsmag"], "energy": ["energy"], "mode": ["mode"], "tkeo": ["mtkeo"],
    "mobility": ["mobility"], "complexity": ["complexity"], "rough": ["rough"], "rugo": ["rugo"], "dfa": ["dfa"],
}
FR_FEATURES = {"cent": ["cent"], "mn": ["mn"], "mod": ["mod"], "sem": ["sem"], "sfm": ["sfm"], "sh": ["sh"]}
EWT_FEATURES = {"permEnt": ["ewt.permEnt"], "shannonEnt": ["ewt.shannonEnt"], "simpsonEnt": ["ewt.simpsonEnt"],
                "renyiEnt": ["ewt.renyiEnt"], "tsallisEnt": ["ewt.tsallisEnt"]}
# Samples of the recordings that the function over batches takes at once (a longer recording alone).
BLOCK = 1 << 17


def _band_names(n_bands: int) -> list[str]:
    return [f"EnergyBand{b}" for b in range(n_bands)] + ["EnergyBandAbove"]


def _renamed_long(df: DataFrame, keys: list[str], mapping: dict[str, list[str]], domain: str) -> DataFrame:
    cols = {}
    for src, names in mapping.items():
        for n in names:
            cols[n] = F.col(f"`{src}`")
    wide = df.select(*keys, *[v.alias(k) for k, v in cols.items()])
    return unpivot(wide, keys, list(cols), "feature", "value").withColumn("domain", F.lit(domain))


def tremor_window_features(
    series: DataFrame,
    record: str,
    order: str,
    value: str,
    sensor: str = "accelerometer",
    fs: float = 100.0,
    window: int = 256,
    step: int = 128,
    n_imf: int | None = None,
    rows: int | None = None,
    band_width: float = 1.0,
    n_bands: int = 25,
) -> DataFrame:
    """Long table ``(record, window_id, axis, imf, domain, feature, value)``, one value per window.

    ``imf`` is NULL for the series itself.
    """
    names = _axis_names(sensor)
    win = _windows(series, record, order, value, names, fs, window, step, rows, False)
    keys = [record, "window_id"]
    long = unpivot(win, [*keys, order], _derived(names), "axis", "v", in_place=True).where(F.col("v").isNotNull())
    # ACF axis of the recorded series, per window; its lag is the order
    acf = SP.acf_windows(long.where(F.col("axis") == names["value"]), keys, order, "v")
    acf_long = acf.select(*keys, F.col("lag").cast(long.schema[order].dataType).alias(order),
                          F.lit(names["acf"]).alias("axis"), F.col("acf").alias("v")).where(F.col("v").isNotNull())
    long = written(long.unionByName(acf_long), "windows")
    # intrinsic mode functions of every (window, axis) series
    imfs = SP.emd(long, [*keys, "axis"], order, "v", max_imf=n_imf)
    imfs = imfs.select(*keys, "axis", F.concat(F.lit("IMF"), F.col("imf").cast("string")).alias("imf"),
                       F.col("i").cast("bigint").alias("i"), F.col("value").alias("v"))
    raw = long.select(*keys, "axis", F.lit(None).cast("string").alias("imf"), F.col(order).cast("bigint").alias("i"), "v")
    imfs = written(raw.unionByName(imfs), "modes")
    gk = [*keys, "axis", "imf"]
    # time domain (windows are bounded: plain windows and percentile buffers are fine here)
    st = FT.series_stats(imfs, gk, ["i"], "v", fs=fs, bounded=True)
    fractal = dfa(imfs, gk, ["i"], "v", bounded=True)
    # frequency domain
    spec = SP.spectrum(imfs, gk, "i", "v", fs)
    tables = [(st, {k: v for k, v in TM_FEATURES.items() if k != "dfa"}, "tm"), (fractal, {"dfa": TM_FEATURES["dfa"]}, "tm"),
              (SP.spectral_stats(spec, gk), FR_FEATURES, "fr"),
              (SP.band_energies(spec, gk, band_width, n_bands), {b: [b] for b in _band_names(n_bands)}, "fr"),
              (SP.energy_entropies(SP.ewt_energies(imfs, gk, "i", "v"), gk), EWT_FEATURES, "fr")]
    out = reduce(DataFrame.unionByName, [_renamed_long(t, gk, feats, domain) for t, feats, domain in tables])
    return out.withColumn("sensor", F.lit(sensor))


def _axis_names(sensor: str) -> dict[str, str]:
    return ACCEL_AXES if sensor == "accelerometer" else GYRO_AXES


def _derived(names: dict[str, str]) -> list[str]:
    """The axes that are columns: all but the ACF axis."""
    return [names[k] for k in ("value", "integral", "derivative", "integral2") if k in names]


def _windows(series: DataFrame, record: str, order: str, value: str, names: dict[str, str], fs: float, window: int, step: int,
             rows: int | None, bounded: bool) -> DataFrame:
    """Rows ``(record, order, axes..., window_id)``: every axis but the ACF's, in windows."""
    s = series.select(record, order, F.col(value).cast("double").alias(names["value"]))
    # a recording takes far more time than its bytes suggest, so tasks are not joined by size
    s = s.repartition(int(s.sparkSession.conf.get("spark.sql.shuffle.partitions")), record) if bounded else spread(s, [record, order], rows)
    s = SR.derived_axes(s, [record], [order], names["value"], fs, prefix="__d", bounded=bounded)
    axes = {names["value"]: F.col(names["value"]), names["integral"]: F.col("__dv"),
            names["derivative"]: F.col("__dj")}
    if "integral2" in names:
        axes[names["integral2"]] = F.col("__dd")
    s = s.select(record, order, *([] if bounded else ["__chunk"]), *[c.alias(a) for a, c in axes.items()])
    return fixed_windows(s, [record], [order], window, step, bounded=bounded)


def _packed_windows(win: DataFrame, record: str, order: str, axes: list[str]) -> DataFrame:
    """Rows ``(record, axis, __x, __y)``: the windows of an axis as arrays of their samples, as they are in ``order``.

    Samples of equal order stand by value in ``__x``, as the transforms have them; for windows
    with such samples ``__y`` has them as they came, as the ordered statistics do (else NULL).
    """
    row = F.struct(F.col(order).alias("o"), F.monotonically_increasing_id().alias("n"), *[F.col(a).alias(f"v{i}") for i, a in enumerate(axes)])
    one = win.select(record, "window_id", row.alias("__r")).groupBy(record, "window_id").agg(F.array_sort(F.collect_list("__r")).alias("__s"))
    one = one.withColumn("__tie", F.size(F.array_distinct(F.transform("__s", lambda r: r["o"]))) < F.size("__s"))

    def cell(i: int, axis: str) -> Column:
        some = F.filter("__s", lambda r: r[f"v{i}"].isNotNull())
        came = F.transform(some, lambda r: r[f"v{i}"])
        by_value = F.transform(F.array_sort(F.transform(some, lambda r: F.struct(r["o"].alias("o"), r[f"v{i}"].alias("v")))), lambda r: r["v"])
        return F.struct(F.lit(axis).alias("axis"), F.when(F.col("__tie"), by_value).otherwise(came).alias("x"),
                        F.when(F.col("__tie"), came).alias("y"))

    cells = one.select(record, F.explode(F.array(*[cell(i, a) for i, a in enumerate(axes)])).alias("__c")).where(F.size("__c.x") > 0)
    packed = cells.groupBy(record, F.col("__c.axis").alias("axis")).agg(F.collect_list(F.struct("__c.x", "__c.y")).alias("__w"))
    return packed.select(record, "axis", F.col("__w.x").alias("__x"), F.col("__w.y").alias("__y"))


def _names_in_order(n_bands: int) -> list[tuple[str, str, str]]:
    """``(domain, name, statistic)`` of every feature."""
    of = [("tm", TM_FEATURES), ("fr", FR_FEATURES), ("fr", {b: [b] for b in _band_names(n_bands)}), ("fr", EWT_FEATURES)]
    return [(domain, name, stat) for domain, names in of for stat, found in names.items() for name in found]


def window_block(x: np.ndarray, y: np.ndarray, stats: list[str], fs: float, band_width: float,
                 n_bands: int) -> tuple[np.ndarray, np.ndarray]:
    """``stats`` of every row of ``x``, series of one length (``y``: their samples as the ordered statistics read them): values, where not NULL."""
    n = x.shape[1]
    found = FT.series_block(y, fs)
    found["dfa"] = dfa_block(y)
    found |= SP.spectral_block(SP._power(x), n, fs, band_width, n_bands)
    values, some = np.zeros((len(x), len(stats))), np.zeros((len(x), len(stats)), dtype=bool)
    for j, name in enumerate(stats):
        if name in found:
            values[:, j], some[:, j] = found[name]
    for rows, energies in SP.ewt_block(x):
        for name, (v, ok) in SP.entropy_block(energies).items():
            values[rows, stats.index(name)], some[rows, stats.index(name)] = v, ok
    return values, some


def _quartiles(values: np.ndarray, some: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The groups, ascending, the quartiles ``(group, 3, column)`` of their rows that are not NULL, and which groups have any."""
    order = np.argsort(group, kind="stable")
    groups, start, size = np.unique(group[order], return_index=True, return_counts=True)
    q, any_ = np.zeros((len(groups), 3, values.shape[1])), np.zeros((len(groups), values.shape[1]), dtype=bool)
    for k in np.unique(size):
        own = np.flatnonzero(size == k)
        at = order[start[own][:, None] + np.arange(k)]
        ok = some[at]
        s, n = np.sort(np.where(ok, values[at], np.nan), axis=1), ok.sum(axis=1)
        any_[own] = n > 0
        q[own] = np.stack(FT.quartiles_sorted(s, np.maximum(n, 1)), axis=1)
    return groups, q, any_


def _series_of(rows: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A list of lists of samples: the row of each series, its length (0 for NULL), and all samples one after another."""
    inner = rows.flatten()
    size = pc.list_value_length(rows).to_numpy(zero_copy_only=False).astype(int)
    length = pc.fill_null(pc.list_value_length(inner), 0).to_numpy(zero_copy_only=False).astype(int)
    return np.repeat(np.arange(len(rows)), size), length, inner.flatten().to_numpy(zero_copy_only=False).astype(float)


QUARTILES = pa.struct([("acf", pa.bool_()), ("imf", pa.int32()), ("f", pa.int32()), ("q1", pa.float64()), ("md", pa.float64()), ("q3", pa.float64())])


def _rolled(xs: pa.Array, ys: pa.Array, with_acf: np.ndarray, names: list[str], n_imf: int | None, fs: float, band_width: float,
            n_bands: int) -> pa.Array:
    """Quartiles across the windows of each row of every feature of the series, of their ACF where asked for, and of all modes of both.

    ``f`` is a feature's place in ``names``; ``imf`` 0 is the series itself.
    """
    row, length, flat = _series_of(xs)
    _, other, came = _series_of(ys)
    start, start_y = np.cumsum(length) - length, np.cumsum(other) - other
    stats = list(dict.fromkeys(names))
    blocks: dict[int, list] = {}
    for n in np.unique(length):
        own = np.flatnonzero(length == n)
        x = flat[start[own][:, None] + np.arange(n)]
        y, tie = x, other[own] > 0
        if tie.any():
            y = x.copy()
            y[tie] = came[start_y[own[tie]][:, None] + np.arange(n)]
        blocks.setdefault(n, []).append((x, y, row[own], np.zeros(len(own), dtype=int)))
        ask = with_acf[row[own]]
        if ask.any():
            acf, some = SP.acf_block(x[ask])
            blocks[n].append((acf[some], acf[some], row[own][ask][some], np.ones(int(some.sum()), dtype=int)))
    values, some, group, most = [], [], [], max(blocks, default=0) + 1  # a series has fewer modes than samples
    for n, parts in blocks.items():
        every = [np.concatenate(p) for p in zip(*parts)]
        per = max(1, BLOCK // max(n, 1))
        for at in range(0, len(every[0]), per):
            x, y, own, acf = (p[at : at + per] for p in every)
            base = (own * 2 + acf) * most
            v, ok = window_block(x, y, stats, fs, band_width, n_bands)
            values.append(v), some.append(ok), group.append(base)
            for j, (active, mode, _, _) in enumerate(SP.emd_block(x.copy(), n_imf), start=1):
                v, ok = window_block(mode, mode, stats, fs, band_width, n_bands)
                values.append(v), some.append(ok), group.append(base[active] + j)
    if not values:
        return pa.array([[]] * len(xs), pa.list_(QUARTILES))
    groups, q, any_ = _quartiles(np.concatenate(values), np.concatenate(some), np.concatenate(group))
    place = np.array([stats.index(name) for name in names])
    g, f = np.nonzero(any_[:, place])
    key = groups[g]
    cells = [pa.array(key // most % 2 == 1), pa.array((key % most).astype(np.int32)), pa.array(f.astype(np.int32)),
             *[pa.array(q[g, i, place[f]]) for i in range(3)]]
    ends = np.searchsorted(key // most // 2, np.arange(len(xs) + 1))
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.StructArray.from_arrays(cells, fields=list(QUARTILES)))


def _roll_up(value_axis: str, names: list[str], n_imf: int | None, fs: float, band_width: float, n_bands: int) -> Callable[..., Column]:
    """``_rolled`` as a function of columns ``(axis, x, y)``, in pieces of ``BLOCK`` samples."""

    def run(axis: pa.Array, x: pa.Array, y: pa.Array) -> pa.Array:
        if not len(x):
            return pa.array([], pa.list_(QUARTILES))
        row, length, _ = _series_of(x)
        piece = np.cumsum(np.bincount(row, weights=length, minlength=len(x))) // BLOCK
        cut = [0, *(np.flatnonzero(np.diff(piece)) + 1), len(x)]
        acf = pc.equal(axis, value_axis).to_numpy(zero_copy_only=False)
        return pa.concat_arrays([_rolled(x[a:b], y[a:b], acf[a:b], names, n_imf, fs, band_width, n_bands) for a, b in zip(cut, cut[1:])])

    run.__annotations__ = {"axis": pa.Array, "x": pa.Array, "y": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "array<struct<acf:boolean,imf:int,f:int,q1:double,md:double,q3:double>>")


def _record_quartiles(series: DataFrame, bounded: bool, record: str, order: str, value: str, sensor: str = "accelerometer",
                      fs: float = 100.0, window: int = 256, step: int = 128, n_imf: int | None = None,
                      rows: int | None = None, band_width: float = 1.0, n_bands: int = 25) -> DataFrame:
    """Quartiles of every feature across the windows of a recording."""
    gk = [record, "axis", "imf", "domain", "feature", "sensor"]
    if not bounded:
        wf = tremor_window_features(series, record, order, value, sensor, fs, window, step, n_imf, rows, band_width, n_bands)
        return group_quantiles(wf.where(F.col("value").isNotNull()), gk, "value", [0.25, 0.5, 0.75], ["q1", "md", "q3"], mode=None)
    names, feats = _axis_names(sensor), _names_in_order(n_bands)
    win = _windows(series, record, order, value, names, fs, window, step, rows, True)
    roll = _roll_up(names["value"], [stat for _, _, stat in feats], n_imf, fs, band_width, n_bands)
    got = _packed_windows(win, record, order, _derived(names)).select(record, "axis", roll("axis", "__x", "__y").alias("__q"))
    got = got.select(record, "axis", F.explode_outer("__q").alias("__q")).where(F.col("__q").isNotNull())
    of = [F.array(*[F.lit(t[i]) for t in feats])[F.col("__q.f")] for i in range(2)]
    return got.select(record, F.when(F.col("__q.acf"), F.lit(names["acf"])).otherwise(F.col("axis")).alias("axis"),
                      F.when(F.col("__q.imf") > 0, F.concat(F.lit("IMF"), F.col("__q.imf").cast("string"))).alias("imf"),
                      of[0].alias("domain"), of[1].alias("feature"), F.lit(sensor).alias("sensor"), *[F.col(f"__q.{n}") for n in ("q1", "md", "q3")])


def tremor_features(
    series: DataFrame,
    record: str,
    order: str,
    value: str,
    sensor: str = "accelerometer",
    individual: DataFrame | None = None,
    participant: str = "healthCode",
    **kw,
) -> DataFrame:
    """Record-level table ``(record, name, value)`` with ``<stat>`` roll-ups across
    windows; with ``individual`` (record -> participant) the ``[STAT]`` roll-up
    ``(participant, name, value)`` across that participant's records instead."""
    gk = [record, "axis", "imf", "domain", "feature", "sensor"]

    def quartiles(part: DataFrame, bounded: bool) -> DataFrame:
        return _record_quartiles(part, bounded, record, order, value, sensor, **kw)

    rec = quartiles(series, False) if kw.get("rows") is not None else by_length(series, [record], quartiles)
    rec = rec.withColumn("iqr", F.col("q3") - F.col("q1"))
    rec_long = unpivot(rec.select(*gk, "md", "iqr"), gk, ["md", "iqr"], "stat", "value")
    name = F.concat_ws("_", F.concat_ws(".", "feature", "domain", "imf", "stat"), "axis", "sensor")
    rec_long = rec_long.withColumn("name", name)
    if individual is None:
        return rec_long.select(record, "name", "value")
    per = same_keys(rec_long, individual.select(record, participant), [record], "inner")
    ind = group_quantiles(per, [participant, "name"], "value", [0.25, 0.5, 0.75], ["q1", "md", "q3"], mode=None)
    ind = ind.select(participant, "name", F.col("md").alias("md"), (F.col("q3") - F.col("q1")).alias("IQR"))
    out = unpivot(ind, [participant, "name"], ["md", "IQR"], "STAT", "value")
    return out.select(participant, F.concat_ws(".", "name", "STAT").alias("name"), "value")
