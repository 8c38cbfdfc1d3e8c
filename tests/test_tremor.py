"""The tremor feature table on the embeddings waveforms (sf0.001)."""

from pyspark.sql import functions as F

from curatio.sensors.tremor import tremor_features, tremor_window_features

SF = "/root/testdata/sf0.001"


def waveforms(spark):
    e = spark.read.parquet(f"{SF}/embeddings.parquet").where("vec_id < 20")
    return e.select("vec_id", "label", F.posexplode("embedding").alias("i", "v"))


def test_window_features_cover_domains_axes_and_imfs(spark):
    wf = tremor_window_features(waveforms(spark), "vec_id", "i", "v", fs=100.0, window=32, step=16, n_imf=2,
                                band_width=10.0, n_bands=5)
    got = {(r.domain, r.axis) for r in wf.select("domain", "axis").distinct().collect()}
    assert {("tm", a) for a in ("ua", "uv", "ud", "uj", "uaacf")} <= got
    assert ("fr", "ua") in got
    feats = {r.feature for r in wf.select("feature").distinct().collect()}
    assert {"md", "median", "mn", "mx", "mtkeo", "mobility", "complexity", "cent", "sfm", "sh", "EnergyBand0",
            "ewt.permEnt", "ewt.shannonEnt", "dfa"} <= feats
    imfs = {r.imf for r in wf.select("imf").distinct().collect()}
    assert "IMF1" in imfs


def test_record_and_individual_rollups_named(spark):
    w = waveforms(spark)
    rec = tremor_features(w, "vec_id", "i", "v", fs=100.0, window=32, step=16, n_imf=1, band_width=10.0, n_bands=5)
    names = {r.name for r in rec.select("name").distinct().collect()}
    assert "mean.tm.IMF1.md_ua_accelerometer" in names and "cent.fr.IMF1.iqr_uaacf_accelerometer" in names
    ind = tremor_features(w, "vec_id", "i", "v", individual=w.select("vec_id", F.col("label").alias("healthCode")).distinct(),
                          fs=100.0, window=32, step=16, n_imf=1, band_width=10.0, n_bands=5)
    inames = {r.name for r in ind.select("name").distinct().collect()}
    assert "skewness.tm.IMF1.md_uv_accelerometer.IQR" in inames


def test_gyroscope_axes(spark):
    wf = tremor_window_features(waveforms(spark), "vec_id", "i", "v", sensor="gyroscope", fs=100.0, window=32,
                                step=16, n_imf=1, band_width=10.0, n_bands=5)
    axes = {r.axis for r in wf.select("axis").distinct().collect()}
    assert axes == {"uav", "uad", "uaa", "uavacf"}
    assert {r.sensor for r in wf.select("sensor").distinct().collect()} == {"gyroscope"}


def test_emd_query_matches_direct_numpy(spark):
    """Brute force on a small fixture: the distributed EMD equals numpy EMD window by window."""
    import numpy as np

    import __spark_entry__ as entry
    from curatio.queries import sensors as S
    from curatio.sensors.spectral import emd_imfs

    got = entry.queries()["emd_imf"](spark, SF).where("vec_id < 5 AND axis = 'ua'").collect()
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.window_id, r.imf), {})[r.i] = r.value
    series = S.tremor_long(spark, SF).where("axis = 'ua' AND vec_id < 5").collect()
    windows = {}
    for r in series:
        windows.setdefault((r.vec_id, r.window_id), []).append((r.i, r.v))
    assert windows
    for (vec, win), pts in windows.items():
        x = np.array([v for _, v in sorted(pts)])
        for j, imf in enumerate(emd_imfs(x), start=1):
            spark_imf = by[(vec, win, j)]
            assert np.allclose([spark_imf[k] for k in range(len(x))], imf, atol=1e-12)
        assert (vec, win, len(emd_imfs(x)) + 1) not in by


def test_tremor_table_value_matches_direct_numpy(spark):
    import numpy as np

    from curatio.sensors.spectral import emd_imfs

    w = waveforms(spark).where("vec_id < 3")
    rec = tremor_features(w, "vec_id", "i", "v", fs=100.0, window=32, step=16, n_imf=1, band_width=10.0, n_bands=5)
    got = {r.vec_id: r.value for r in rec.where(F.col("name") == "mean.tm.IMF1.md_ua_accelerometer").collect()}
    for vec in range(3):
        x = np.array([r.v for r in w.where(f"vec_id = {vec}").orderBy("i").collect()], dtype=float)
        means = [emd_imfs(x[s:s + 32], 1)[0].mean() for s in range(0, len(x) - 32 + 1, 16)]
        assert abs(got[vec] - float(np.median(means))) < 1e-9
