"""Named feature tables agree with the oracle-checked registered queries on the same stand-ins."""

import math

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from curatio.queries import sensors as S
from curatio.sensors.activities import REST_NAMES, rest_features, tapping_features, walk_features

SF = "/root/testdata/sf0.001"
Q = entry.queries()


def close(a, b, tol=1e-5):
    if a is None or b is None:
        return a is None and b is None
    return math.isclose(a, b, rel_tol=tol, abs_tol=tol)


def test_tapping_table_matches_queries(spark):
    tab = tapping_features(S.taps(spark, SF), "record_id", S.TAP_ORDER, "t")
    assert len(tab.columns) == 43  # record + 42 features
    got = {r.record_id: r for r in tab.collect()}
    basic = Q["tap_basic_stats"](spark, SF).collect()
    for r in basic:
        row = got[r.record_id]
        for stat in ("mean", "median", "iqr", "sd", "mad", "range"):
            assert close(row[f"{stat}{r.series}"], r[stat]), (r.record_id, r.series, stat)
    for r in Q["tap_autocorr"](spark, SF).collect():
        assert close(got[r.record_id]["ar1TapInter"], r.ar1)
    for r in Q["tap_fatigue"](spark, SF).collect():
        assert close(got[r.record_id]["fatigue25TapInter"], r.fatigue25, 1e-3)
    for r in Q["tap_counts"](spark, SF).collect():
        assert got[r.record_id]["numberTaps"] == r.numberTaps


def test_walk_table_matches_queries(spark):
    w = S.walk(spark, SF)
    tab = walk_features(w, "record_id", S.WALK_ORDER, "t",
                        f_min=S.LS_GRID[0], f_max=S.LS_GRID[1], n_freq=S.LS_GRID[2])
    assert len(tab.columns) == 1 + 17 * 5 + 3
    got = {r.record_id: r for r in tab.collect()}
    for r in Q["walk_moments"](spark, SF).collect():
        assert close(got[r.record_id][f"mean{r.axis}"], r.mean) and close(got[r.record_id][f"cv{r.axis}"], r.cv)
    for r in Q["walk_quantiles"](spark, SF).collect():
        assert close(got[r.record_id][f"iqr{r.axis}"], r.iqr) and close(got[r.record_id][f"mode{r.axis}"], r["mode"])
    for r in Q["walk_dfa"](spark, SF).collect():
        assert close(got[r.record_id][f"dfa{r.axis}"], r.dfa)
    for r in Q["walk_lomb_scargle"](spark, SF).collect():
        assert close(got[r.record_id][f"F0{r.axis}"], r.F0)
    for r in Q["walk_corr"](spark, SF).collect():
        assert close(got[r.record_id]["corXZ"], r.corXZ)


def test_rest_table_matches_queries(spark):
    w = S.walk(spark, SF)
    tab = rest_features(w, "record_id", S.WALK_ORDER, "t", fs=1.0, f_min=S.LS_GRID[0], f_max=S.LS_GRID[1], n_freq=S.LS_GRID[2])
    assert tab.columns == ["record_id", *REST_NAMES]
    got = {r.record_id: r for r in tab.collect()}
    for r in Q["rest_features"](spark, SF).collect():
        for name in ("meanAA", "medianAA", "acfAA", "dfaAA", "turningTime", "Postpeak"):
            assert close(got[r.record_id][name], r[name]), name
    for r in Q["rest_displacement"](spark, SF).collect():
        assert close(math.log10(got[r.record_id]["dVol"]), r.log10_dVol)
