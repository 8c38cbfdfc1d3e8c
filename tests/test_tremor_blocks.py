"""Recordings that fit a task: their windows go through blocks of arrays, with the values of the row operators."""

import math

import numpy as np
from pyspark.sql import functions as F

from curatio.sensors import spectral as SP
from curatio.sensors.tremor import _record_quartiles, tremor_features

KW = dict(record="r", order="i", value="v", window=16, step=8, band_width=10.0, n_bands=5)
KEYS = ("r", "axis", "imf", "domain", "feature", "sensor")


def recordings(spark):
    rng = np.random.default_rng(3)
    rows = [(n, i, float(v)) for n in (1, 2, 3, 4, 5, 7, 9, 41) for i, v in enumerate(rng.normal(size=n))]
    rows += [(100, i, 0.0) for i in range(20)] + [(101, i, 2.0) for i in range(20)] + [(104, i, 0.5 * i) for i in range(20)]
    rows += [(102, i, None if i % 5 == 0 else float(i * i % 7)) for i in range(30)]
    rows += [(103, i, float(v)) for i, v in enumerate(rng.integers(0, 3, size=40))]
    rows += [(None, i, math.sin(i)) for i in range(24)]
    return spark.createDataFrame(rows, "r long, i int, v double").repartition(3)


def test_blocks_agree_with_the_row_operators(spark):
    df = recordings(spark)
    for sensor in ("accelerometer", "gyroscope"):
        a, b = ({tuple(x[k] for k in KEYS): (x.q1, x.md, x.q3) for x in _record_quartiles(df, bounded, sensor=sensor, **KW).collect()}
                for bounded in (True, False))
        assert a.keys() == b.keys() and any(k[2] == "IMF2" for k in a)
        for k, row in a.items():
            for v, w in zip(row, b[k]):
                assert math.isclose(v, w, rel_tol=1e-6, abs_tol=1e-9), (k, row, b[k])


def test_nothing_is_written_between_and_the_transforms_run_once(spark):
    df, tables = recordings(spark), {t.name for t in spark.catalog.listTables()}
    plan = _record_quartiles(df, True, **KW)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and plan.count("Exchange hashpartitioning(r#") == 1
    assert {t.name for t in spark.catalog.listTables()} == tables


def test_small_pieces_and_many_recordings_give_the_same_rows(spark, monkeypatch):
    from curatio.sensors import tremor as TR

    df = recordings(spark).where("r = 41")
    one = {(x.name, x.value) for x in tremor_features(df, **KW).collect()}
    copies = df.crossJoin(spark.range(50).select(F.col("id").alias("c"))).select(F.col("c").alias("r"), "i", "v")
    monkeypatch.setattr(TR, "BLOCK", 100)
    rows = tremor_features(copies, **KW).collect()
    assert len(rows) == 50 * len(one) and {(x.name, x.value) for x in rows} == one


def test_wavelet_energies_by_block(spark):
    rng = np.random.default_rng(4)
    for n in (2, 3, 4, 7, 16, 31):
        x = rng.normal(size=(60, n))
        x[:5], x[5:9] = 0.0, 3.5
        got = {int(r): e for rows, energies in SP.ewt_block(x) for r, e in zip(rows, energies)}
        assert sorted(got) == list(range(60))
        for r, e in got.items():
            want = SP.ewt_band_energies_np(x[r])
            assert len(e) == len(want) and np.allclose(e, want, rtol=1e-9, atol=1e-12)
