"""Signal tests with closed-form answers and plan checks for the sensor features."""

import math

import numpy as np
from pyspark.sql import functions as F

from curatio.sensors import features as FT
from curatio.sensors import series as SR
from curatio.sensors import spectral as SP
from curatio.sensors.fractal import dfa
from curatio.sensors.periodogram import lomb_scargle_peak, lomb_scargle_power, phase_moments


def series(spark, values, rec="r"):
    return spark.createDataFrame([(rec, i, float(i), float(v)) for i, v in enumerate(values)],
                                 "record_id string, i int, t double, v double")


def test_constant_series_gives_null_not_error(spark):
    df = series(spark, [0.0] * 10)
    r = FT.series_stats(df, ["record_id"], ["i"]).collect()[0]
    assert r.cv is None and r.skew is None and r.kur is None and r.acf1 is None
    c = df.withColumn("w", F.col("v")).groupBy("record_id").agg(FT.correlation("v", "w").alias("c")).collect()[0]
    assert c.c is None


def test_moments_match_numpy(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=200)
    r = FT.series_stats(series(spark, x), ["record_id"], ["i"]).collect()[0]
    c = x - x.mean()
    assert math.isclose(r.mean, x.mean(), rel_tol=1e-12)
    assert math.isclose(r.sd, x.std(ddof=1), rel_tol=1e-12)
    assert math.isclose(r.skew, (c ** 3).mean() / (c ** 2).mean() ** 1.5, rel_tol=1e-9)
    assert math.isclose(r.kur, (c ** 4).mean() / (c ** 2).mean() ** 2 - 3, rel_tol=1e-9)
    assert math.isclose(r.median, float(np.quantile(x, 0.5)), rel_tol=1e-12)
    assert math.isclose(r.acf1, (c[:-1] * c[1:]).sum() / (c * c).sum(), rel_tol=1e-9)
    assert math.isclose(r.tkeo, (x[1:-1] ** 2 - x[:-2] * x[2:]).mean(), rel_tol=1e-9)


def test_mode_smallest_on_tie(spark):
    r = FT.series_stats(series(spark, [3, 1, 1, 3, 2]), ["record_id"], groups=("quantiles",)).collect()[0]
    assert r["mode"] == 1.0


def test_lomb_scargle_finds_sine_frequency(spark):
    f0 = 2.0
    t = np.arange(256) / 64.0
    df = spark.createDataFrame([("r", float(tt), float(math.sin(2 * math.pi * f0 * tt))) for tt in t],
                               "record_id string, t double, v double")
    r = lomb_scargle_peak(df, ["record_id"], "t", "v", 0.5, 10.0, 20).collect()[0]
    assert abs(r.F0 - f0) < 1e-9 and r.P0 > 10


def test_fft_peak_at_sine_frequency(spark):
    fs, f0, n = 64.0, 8.0, 64
    df = spark.createDataFrame([("r", i, float(math.sin(2 * math.pi * f0 * i / fs))) for i in range(n)],
                               "record_id string, i int, v double")
    spec = SP.spectrum(df, ["record_id"], "i", "v", fs)
    st = SP.spectral_stats(spec, ["record_id"]).collect()[0]
    assert abs(st["mod"] - f0) < 1e-9 and abs(st.cent - f0) < 1e-6


def test_dfa_white_noise_near_half(spark):
    rng = np.random.default_rng(7)
    r = dfa(series(spark, rng.normal(size=2048)), ["record_id"], ["i"]).collect()[0]
    assert 0.35 < r.dfa < 0.65


def test_emd_imfs_and_ewt_energy_conservation():
    t = np.arange(512)
    x = np.sin(2 * math.pi * t / 16) + 0.5 * np.sin(2 * math.pi * t / 100)
    imfs = SP.emd_imfs(x)
    assert len(imfs) >= 1
    resid = x - np.sum(imfs, axis=0)
    assert np.sum(resid ** 2) <= np.sum(x ** 2)
    e = SP.ewt_band_energies_np(x, 5)
    total = np.sum(np.abs(np.fft.rfft(x - x.mean())) ** 2)
    assert math.isclose(e.sum(), total, rel_tol=1e-9)


def test_displacement_of_constant_acceleration(spark):
    df = spark.createDataFrame([("r", i, 1.0) for i in range(5)], "record_id string, i int, a double")
    out = SR.derived_axes(df, ["record_id"], ["i"], "a", 1.0).orderBy("i").collect()
    assert [r.uv for r in out] == [1.0, 2.0, 3.0, 4.0, 5.0]
    assert [r.ud for r in out] == [1.0, 3.0, 6.0, 10.0, 15.0]


def test_native_features_have_no_python_eval(spark):
    df = series(spark, range(50))
    plan = FT.series_stats(df, ["record_id"], ["i"])._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    # no row per sample and frequency, and no sample passes through Python
    plan = lomb_scargle_peak(df, ["record_id"], "t", "v")._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Cross" not in plan
    moments = phase_moments(df, ["record_id"], "t", "v", 0.2, 20.0, 100)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in moments and "Python" not in moments


def brute_lomb(t, y, freqs):
    """The periodogram frequency by frequency."""
    y, out = y - np.mean(y), []
    for f in freqs:
        w = 2 * np.pi * f
        tau = np.arctan2(np.sin(2 * w * t).sum(), np.cos(2 * w * t).sum()) / (2 * w)
        c, s = np.cos(w * (t - tau)), np.sin(w * (t - tau))
        out.append(((y @ c) ** 2 / (c @ c) + (y @ s) ** 2 / (s @ s)) / (2 * y.var(ddof=1)))
    return np.array(out)


def test_lomb_scargle_equals_brute_force_far_from_the_origin(spark):
    r = np.random.default_rng(5)
    recs = {"near": (np.sort(r.uniform(0, 30, 200)), r.normal(size=200)),
            "far": (1.7e9 + np.sort(r.uniform(0, 5000, 300)), 1e5 + r.normal(size=300)),
            None: (np.sort(r.uniform(0, 9, 40)), r.normal(size=40)), "flat": (np.arange(9.0), np.full(9, 3.0))}
    df = spark.createDataFrame([(k, float(a), float(b)) for k, (t, y) in recs.items() for a, b in zip(t, y)] + [("near", None, 1.0), ("near", 2.0, None)],
                               "r string, t double, v double")
    grid = (0.13, 3.7, 37)
    freqs = grid[0] + np.arange(grid[2]) * (grid[1] - grid[0]) / (grid[2] - 1)
    power = {x.r: x.power for x in lomb_scargle_power(df, ["r"], "t", "v", *grid).collect()}
    peak = {x.r: (x.F0, x.P0) for x in lomb_scargle_peak(df, ["r"], "t", "v", *grid).collect()}
    assert power.pop("flat") is None and peak.pop("flat") == (None, None)
    assert set(power) == {"near", "far", None}
    for k, got in power.items():
        t, y = recs[k]
        want = brute_lomb(t - t.min(), y, freqs)
        assert np.allclose(got, want, rtol=1e-7, atol=1e-9)
        assert math.isclose(peak[k][0], freqs[want.argmax()]) and math.isclose(peak[k][1], want.max(), rel_tol=1e-7)
    one = lomb_scargle_peak(df.where("r = 'near'"), ["r"], "t", "v", 0.4, 0.4, 1).first()
    t, y = recs["near"]
    assert math.isclose(one.P0, brute_lomb(t, y, [0.4])[0], rel_tol=1e-9) and one.F0 == 0.4


def test_meyer_filter_bank_is_a_tight_frame():
    omega = np.linspace(0, np.pi, 513)
    bank = SP.meyer_filter_bank(omega, np.array([0.3, 1.0, 2.2]))
    assert bank.shape == (4, 513)
    assert np.allclose(bank.sum(axis=0), 1.0)
    assert (bank >= -1e-12).all() and (bank <= 1 + 1e-12).all()


def test_mode_rounding_and_sampling_rate(spark):
    df = spark.createDataFrame([("r", i, float(i) / 50.0, v) for i, v in enumerate([1.01, 1.02, 2.0, 1.04, 3.0])],
                               "record_id string, i int, t double, v double")
    exact = FT.series_stats(df, ["record_id"], groups=("quantiles",)).collect()[0]["mode"]
    rounded = FT.series_stats(df, ["record_id"], groups=("quantiles",), mode_digits=1, bounded=True).collect()[0]["mode"]
    hist = FT.series_stats(df, ["record_id"], groups=("quantiles",), mode_digits=1, rows=2).collect()[0]
    assert exact == 1.01 and rounded == 1.0 and hist["mode"] == 1.0
    fs = SR.sampling_rate(df, ["record_id"], ["i"], "t", rows=2).collect()[0].fs
    assert abs(fs - 50.0) < 1e-9
