"""Rolled up wide by recording, or by rows where recordings are long: the same tremor names and values."""

import math

import numpy as np

from curatio.sensors import spectral as SP
from curatio.sensors.tremor import _record_quartiles


def test_quartiles_agree_however_recordings_are_cut(spark):
    rng = np.random.default_rng(8)
    rows = [(r, i, float(v)) for r, n in ((1, 70), (None, 40)) for i, v in enumerate(rng.normal(size=n))]
    df = spark.createDataFrame(rows, "r long, i int, v double")
    kw = dict(record="r", order="i", value="v", window=32, step=16, n_imf=0, band_width=10.0, n_bands=5)
    keys = ("r", "axis", "imf", "domain", "feature", "sensor")
    a, b = ({tuple(x[k] for k in keys): (x.q1, x.md, x.q3) for x in _record_quartiles(df, bounded, **kw).collect()}
            for bounded in (True, False))
    assert a.keys() == b.keys() and {k[0] for k in a} == {1, None}
    for k, row in a.items():
        for v, w in zip(row, b[k]):
            assert math.isclose(v, w, rel_tol=1e-6, abs_tol=1e-9), (k, row, b[k])


def test_transforms_run_once_a_window(spark):
    df = spark.createDataFrame([(1, i, float(i % 7)) for i in range(32)], "r long, i int, v double")
    for out in (SP.spectrum(df, ["r"], "i", "v", 100.0), SP.acf_windows(df, ["r"], "i", "v"), SP.emd(df, ["r"], "i", "v"),
                SP.ewt_energies(df, ["r"], "i", "v")):
        assert out._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
