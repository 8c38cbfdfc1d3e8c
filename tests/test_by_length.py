"""Records that fit a task take one shuffle; longer ones are cut into chunks; both give the same rows."""

import math

import numpy as np
from pyspark.sql import functions as F

from curatio.operators.reshape import unpivot
from curatio.operators.segmented import by_length
from curatio.sensors import features as FT
from curatio.sensors.activities import rest_features, walk_features
from curatio.sensors.fractal import dfa
from curatio.sensors.periodogram import lomb_scargle_peak, sample_sums, power_from_sums
from curatio.session import bucketed

KEYS = ["r", "axis"]


def samples(spark, lengths=((1, 40), (2, 300), (None, 25), (4, 1))):
    rng = np.random.default_rng(3)
    rows = [(r, i, float(i) * 0.5, None if i % 11 == 5 else float(round(x, 1)), float(y)) for r, n in lengths
            for i, (x, y) in enumerate(rng.normal(size=(n, 2)))]
    return spark.createDataFrame(rows, "r long, i int, t double, x double, y double")


def long_form(df):
    return unpivot(df, ["r", "i", "t"], ["x", "y"], "axis", "v", in_place=True).where("v IS NOT NULL")


def same(a, b):
    a, b = ({tuple(r[k] for k in KEYS): r.asDict() for r in d.collect()} for d in (a, b))
    assert a.keys() == b.keys() and len(a) == 8
    for k, row in a.items():
        for n, v in row.items():
            w = b[k][n]
            assert v == w or math.isclose(v, w, rel_tol=1e-7, abs_tol=1e-9), (k, n, v, w)


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


def test_short_and_long_records_agree_with_one_window_a_record(spark):
    df = samples(spark)
    jobs = [lambda d, b: FT.series_stats(long_form(d), KEYS, ["i"], bounded=b),
            lambda d, b: dfa(long_form(d), KEYS, ["i"], bounded=b),
            lambda d, b: lomb_scargle_peak(long_form(d), KEYS, "t", "v", 0.05, 0.9, 30, bounded=b)]
    for job in jobs:
        # record 2 alone is longer than 100 samples
        same(by_length(df, ["r"], job, rows=100), job(df, True))


def test_bounded_statistics_of_all_axes_take_one_shuffle(spark):
    df = samples(spark).repartition("r")
    long = long_form(df)
    for out in (FT.order_stats(long, KEYS, ["i"], bounded=True), FT.quantile_stats(long, KEYS, bounded=True),
                lomb_scargle_peak(long, KEYS, "t", "v", 0.05, 0.9, 30, bounded=True)):
        assert exchanges(out) == 1


def test_bucketed_series_is_read_without_shuffle(spark):
    df = samples(spark)
    kept = bucketed(df, ["r"])
    out = FT.order_stats(long_form(kept), KEYS, ["i"], bounded=True)
    assert exchanges(out) == 0
    same(out, FT.order_stats(long_form(df), KEYS, ["i"], bounded=True))


def test_sums_by_sample_equal_the_definition():
    rng = np.random.default_rng(5)
    t, y = np.sort(rng.uniform(0, 500, 700)), rng.normal(size=700)
    got = sample_sums(t, y, 0.01, 0.02, 25, piece=128)
    w = 2j * np.pi * (0.01 + 0.02 * np.arange(25))[:, None] * t
    want = np.array([np.exp(w).sum(axis=1), np.exp(w) @ y, np.exp(2 * w).sum(axis=1)])
    assert np.allclose(got, want, rtol=0, atol=1e-9)
    assert np.isfinite(power_from_sums(got, 700, float(np.var(y, ddof=1)))).all()


def test_wide_tables_are_the_same_in_chunks(spark):
    df = samples(spark, ((1, 60), (None, 30))).withColumn("z", F.col("x") * F.col("y") + 1)
    for table in (walk_features, rest_features):
        kw = dict(record="r", order=["i"], t="t", axes=("x", "y", "z"), f_min=0.05, f_max=0.9, n_freq=20)
        whole = {r.r: r.asDict() for r in table(df, **kw).collect()}
        cut = {r.r: r.asDict() for r in table(df, rows=20, **kw).collect()}
        assert whole.keys() == cut.keys() == {1, None}
        for k, row in whole.items():
            for n, v in row.items():
                assert v == cut[k][n] or math.isclose(v, cut[k][n], rel_tol=1e-6, abs_tol=1e-9), (k, n)
