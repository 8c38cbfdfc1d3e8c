"""Named feature tables per activity: one row per recording, the dictionary's names.

Each function composes the native statistics (``features``), DFA and the
Lomb-Scargle peak into the wide table a study releases:

* ``tapping_features`` - the 42 tapping features (``meanTapInter`` ...
  ``corXY``);
* ``walk_features``    - ``<feature><axis>`` for 17 features x axes X, Y, Z,
  AA, AJ, plus ``corXY``, ``corXZ``, ``corYZ``;
* ``rest_features``    - the 19 balance features on the AA series.

Each series is written once; order, box and trigonometric statistics, quantiles
and moments all read that.  Walks and rests are written into buckets by record
(``session.bucketed``), so that none of the readers shuffles them again; records longer
than a task's window (``by_length``) and taps are spread over tasks by rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatio.functions.expr import as_col
from curatio.operators.joins import same_keys
from curatio.operators.reshape import unpivot
from curatio.operators.segmented import by_length, segmented, spread
from curatio.sensors import features as FT
from curatio.sensors import series as SR
from curatio.sensors.fractal import dfa
from curatio.sensors.periodogram import lomb_scargle_peak
from curatio.session import bucketed

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# ---------------------------------------------------------------------------
# Statistic prefixes of the tapping series, in the dictionary's order.
TAP_STATS = ["mean", "median", "iqr", "min", "max", "skew", "kur", "sd", "mad", "cv", "range"]
TAP_INTER_EXTRA = ["tkeo", "ar1", "ar2", "fatigue10", "fatigue25", "fatigue50"]
TAP_SERIES = ["TapInter", "DriftLeft", "DriftRight"]
# Walking features (prefix) and axes, in the dictionary's order.
WALK_STATS = ["mean", "sd", "mode", "skew", "kur", "q1", "median", "q3", "iqr", "range", "acf", "zcr", "dfa", "cv",
              "tkeo", "F0", "P0"]
WALK_AXES = ["X", "Y", "Z", "AA", "AJ"]
# Rest features in the dictionary's order.
REST_NAMES = ["meanAA", "sdAA", "modeAA", "skewAA", "kurAA", "q1AA", "medianAA", "q3AA", "iqrAA", "rangeAA", "acfAA",
              "zcrAA", "dfaAA", "turningTime", "Postpeak", "Postpower", "Alpha", "dVol", "ddVol"]


def tapping_names() -> list[str]:
    """Names of the 42 tapping features."""
    return ([f"{s}TapInter" for s in TAP_STATS + TAP_INTER_EXTRA]
            + [f"{s}{ser}" for ser in TAP_SERIES[1:] for s in TAP_STATS]
            + ["numberTaps", "buttonNoneFreq", "corXY"])


def walk_names() -> list[str]:
    """Names of the walking features: 17 on five axes, and three correlations."""
    return [f"{s}{a}" for s in WALK_STATS for a in WALK_AXES] + ["corXY", "corXZ", "corYZ"]


def _pivot_wide(long: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """(keys, name, value) -> one column per name, explicit list (no discovery job)."""
    return long.groupBy(*[as_col(k) for k in keys]).pivot("name", list(names)).agg(F.first("value"))


def tapping_features(
    taps: DataFrame,
    record: str = "record_id",
    order: Sequence[str] = ("t",),
    t: str = "t",
    x: str = "x",
    y: str = "y",
    button: str = "button",
    rows: int | None = None,
) -> DataFrame:
    """The 42 tapping features per record.

    ``taps``: one row per tap with its time ``t`` (seconds), coordinates and
    the button hit (``left``/``right``/``none``).
    """
    order = list(order)
    inter = SR.tap_intervals(taps, [record], order, t, "v", rows=rows).select(
        record, *order, F.lit("TapInter").alias("series"), "v")
    drift = SR.button_drift(taps, [record], order, button, x, y, "v", rows=rows).select(
        record, *order, F.when(F.col(button) == "left", "DriftLeft").otherwise("DriftRight").alias("series"), "v")
    s = spread(inter.unionByName(drift), [record, "series", *order], rows)
    st = FT.series_stats(s, [record, "series"], order)
    stat_cols = {"mean": "mean", "median": "median", "iqr": "iqr", "min": "min", "max": "max", "skew": "skew",
                 "kur": "kur", "sd": "sd", "mad": "mad", "cv": "cv", "range": "range", "tkeo": "tkeo",
                 "ar1": "acf1", "ar2": "acf2"}
    long = unpivot(st.select(record, "series", *[F.col(v).alias(k) for k, v in stat_cols.items()]),
                   [record, "series"], list(stat_cols), "stat", "value")
    fat = FT.fatigue(s.where(F.col("series") == "TapInter"), [record, "series"], order, "v")
    fat_long = unpivot(fat, [record, "series"], ["fatigue10", "fatigue25", "fatigue50"], "stat", "value")
    long = long.unionByName(fat_long.select(record, "series", "stat", "value"))
    long = long.withColumn("name", F.concat("stat", "series"))
    counts = taps.groupBy(record).agg(
        F.count(F.lit(1)).cast("double").alias("numberTaps"),
        F.avg(F.when(F.col(button) == "none", 1.0).otherwise(0.0)).alias("buttonNoneFreq"),
        FT.correlation(x, y).alias("corXY"),
    )
    counts_long = unpivot(counts, [record], ["numberTaps", "buttonNoneFreq", "corXY"], "name", "value")
    names = tapping_names()
    all_long = long.select(record, "name", "value").unionByName(counts_long.select(record, "name", "value"))
    return _pivot_wide(all_long, [record], names)


def walk_features(
    accel: DataFrame,
    record: str = "record_id",
    order: Sequence[str] = ("t",),
    t: str = "t",
    axes: Sequence[str] = ("X", "Y", "Z"),
    rows: int | None = None,
    f_min: float = 0.2,
    f_max: float = 20.0,
    n_freq: int = 100,
) -> DataFrame:
    """``<feature><axis>`` for the 17 walking features on X, Y, Z, AA, AJ plus the three correlations."""
    order = list(order)
    X, Y, Z = axes
    ids = [record, *dict.fromkeys([*order, t])]
    w = accel.select(*ids, F.col(X).alias("X"), F.col(Y).alias("Y"), F.col(Z).alias("Z"))
    if rows is not None:
        return _walk_features(w, record, order, t, rows, f_min, f_max, n_freq, False)
    return by_length(w, [record], lambda part, bounded: _walk_features(part, record, order, t, rows, f_min, f_max, n_freq, bounded))


def _walk_features(w: DataFrame, record: str, order: list[str], t: str, rows: int | None, f_min: float, f_max: float,
                   n_freq: int, bounded: bool) -> DataFrame:
    ids = [record, *dict.fromkeys([*order, t])]
    w = w.withColumn("AA", SR.magnitude(["X", "Y", "Z"]))
    w = SR.with_jerk(w, [record], order, ["X", "Y", "Z"], "AJ", rows=rows, bounded=bounded)
    keys = [record, "axis"]
    if bounded:
        w = bucketed(w, [record], "series", placed=True)
    long = unpivot(w, ids, WALK_AXES, "axis", "v", in_place=True).where(F.col("v").isNotNull())
    if not bounded:
        long = spread(long, [*keys, *order], rows)
    st = FT.series_stats(long, keys, order, bounded=bounded)
    d = dfa(long, keys, order, bounded=bounded)
    ls = lomb_scargle_peak(long, keys, t, "v", f_min, f_max, n_freq, bounded=bounded)
    per_axis = same_keys(same_keys(st, d, keys), ls, keys).select(
        *keys, "mean", "sd", "mode", "skew", "kur", "q1", "median", "q3", "iqr", "range",
        F.col("acf1").alias("acf"), "zcr", "dfa", "cv", "tkeo", "F0", "P0")
    long_stats = unpivot(per_axis, keys, WALK_STATS, "stat", "value").withColumn("name", F.concat("stat", "axis"))
    cors = w.groupBy(record).agg(FT.correlation("X", "Y").alias("corXY"), FT.correlation("X", "Z").alias("corXZ"),
                                 FT.correlation("Y", "Z").alias("corYZ"))
    cors_long = unpivot(cors, [record], ["corXY", "corXZ", "corYZ"], "name", "value")
    names = walk_names()
    return _pivot_wide(long_stats.select(record, "name", "value").unionByName(cors_long), [record], names)


def rest_features(
    accel: DataFrame,
    record: str = "record_id",
    order: Sequence[str] = ("t",),
    t: str = "t",
    axes: Sequence[str] = ("X", "Y", "Z"),
    fs: float = 100.0,
    rows: int | None = None,
    f_min: float = 0.2,
    f_max: float = 20.0,
    n_freq: int = 100,
) -> DataFrame:
    """The 19 balance features (see the README for the conventions of turning
    time, posture peak/power and the displacement volumes)."""
    order = list(order)
    X, Y, Z = axes
    s = accel.select(record, *dict.fromkeys([*order, t]), X, Y, Z, SR.magnitude([X, Y, Z]).alias("v"))
    if rows is not None:
        return _rest_features(s, record, order, t, axes, fs, rows, f_min, f_max, n_freq, False)
    return by_length(s, [record], lambda part, bounded: _rest_features(part, record, order, t, axes, fs, rows, f_min, f_max, n_freq, bounded))


def _rest_features(s: DataFrame, record: str, order: list[str], t: str, axes: Sequence[str], fs: float, rows: int | None,
                   f_min: float, f_max: float, n_freq: int, bounded: bool) -> DataFrame:
    X, Y, Z = axes
    s = bucketed(s, [record], "series") if bounded else spread(s, [record, *order], rows)
    aa = s.drop(X, Y, Z)
    st = FT.series_stats(aa, [record], order, bounded=bounded)
    d = dfa(aa, [record], order, bounded=bounded)
    tt = aa.groupBy(record).agg((F.max_by(t, F.struct(F.col("v"), -F.col(t))) - F.min(t)).alias("turningTime"))
    ls = lomb_scargle_peak(aa, [record], t, "v", f_min, f_max, n_freq, bounded=bounded)
    inv2 = 1.0 / (fs * fs)
    disp = segmented(s.drop("v"), [record], order, bounded=bounded,
                     position="pos__", running={a: f"{a}_v" for a in (X, Y, Z)},
                     running2={a: f"{a}_d" for a in (X, Y, Z)})
    vol = None
    dvol = None
    for a in (X, Y, Z):
        r = (F.max(f"{a}_d") - F.min(f"{a}_d")) * F.lit(inv2)
        dd = F.when(F.col("pos__") > 0, F.col(f"{a}_v"))
        r2 = (F.max(dd) - F.min(dd)) * F.lit(inv2)
        vol = r if vol is None else vol * r
        dvol = r2 if dvol is None else dvol * r2
    vols = disp.groupBy(record).agg(vol.alias("dVol"), dvol.alias("ddVol"))
    out = (
        same_keys(same_keys(same_keys(same_keys(st, d, [record]), tt, [record], "inner"), ls, [record]), vols, [record], "inner")
        .select(
            record, F.col("mean").alias("meanAA"), F.col("sd").alias("sdAA"), F.col("mode").alias("modeAA"),
            F.col("skew").alias("skewAA"), F.col("kur").alias("kurAA"), F.col("q1").alias("q1AA"),
            F.col("median").alias("medianAA"), F.col("q3").alias("q3AA"), F.col("iqr").alias("iqrAA"),
            F.col("range").alias("rangeAA"), F.col("acf1").alias("acfAA"), F.col("zcr").alias("zcrAA"),
            F.col("dfa").alias("dfaAA"), "turningTime", F.col("F0").alias("Postpeak"),
            F.col("P0").alias("Postpower"), F.col("dfa").alias("Alpha"), "dVol", "ddVol",
        )
    )
    return out
