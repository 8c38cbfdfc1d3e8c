"""The chunked series primitive equals plain per-record windows for any number of rows a chunk."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from curatio.operators.segmented import segmented, spread


@pytest.fixture(scope="module")
def data(spark):
    # 3 records of different lengths, irregular times, a few NULL values
    return spark.range(0, 700).selectExpr(
        "CAST(id % 3 AS INT) AS rec",
        "CAST(id * 7 % 1000 AS DOUBLE) + id / 1000.0 AS t",
        "id",
        "CASE WHEN id % 97 = 5 THEN NULL ELSE sin(id) * 10 END AS x",
        "cos(id) AS z",
    )


def plain(df):
    w = Window.partitionBy("rec").orderBy("t", "id")
    df = df.withColumn("cz", F.sum("z").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    p = Window.partitionBy("rec")
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.select(
        "rec", "id",
        (F.row_number().over(w) - 1).alias("pos"), F.count(F.lit(1)).over(p).alias("n"),
        F.lag("x", 1).over(w).alias("lag1_x"), F.lag("x", 3).over(w).alias("lag3_x"),
        F.lead("x", 1).over(w).alias("lead1_x"), F.lead("x", 2).over(w).alias("lead2_x"),
        F.sum("x").over(run).alias("cx"), F.avg("x").over(p).alias("mx"),
        F.sum("cz").over(run).alias("c2z"),
    )


@pytest.mark.parametrize("cut", [dict(bounded=True), dict(rows=3), dict(rows=40), dict(rows=400), {}])
def test_segmented_equals_plain_windows(data, cut):
    seg = segmented(data, ["rec"], ["t", "id"], **cut, position="pos", length="n",
                    lags={"x": [1, 3]}, leads={"x": [1, 2]}, running={"x": "cx"}, means={"x": "mx"},
                    running2={"z": "c2z"})
    cols = ["rec", "id", "pos", "n", "lag1_x", "lag3_x", "lead1_x", "lead2_x", "cx", "mx", "c2z"]

    def key(r):
        return tuple(None if v is None else (round(v, 5) if isinstance(v, float) else v) for v in r)

    a = sorted(key(r) for r in seg.select(*cols).collect())
    b = sorted(key(r) for r in plain(data).select(*cols).collect())
    assert a == b


@pytest.mark.parametrize("rows", [None, 5, 40])
def test_histogram_quantiles_equal_percentile(spark, rows):
    from curatio.operators.quantiles import group_quantiles

    df = spark.range(0, 900).selectExpr("CAST(id % 4 AS INT) AS g",
                                        "CASE WHEN id % 50 = 0 THEN NULL ELSE round(sin(id) * 5, 1) END AS v")
    q = group_quantiles(df, ["g"], "v", [0.1, 0.25, 0.5, 0.9], ["a", "b", "c", "d"], rows=rows)
    ref = df.groupBy("g").agg(F.percentile("v", [0.1, 0.25, 0.5, 0.9]).alias("q"), F.mode("v", True).alias("m"))
    got = {r.g: (r.a, r.b, r.c, r.d, r["mode"]) for r in q.collect()}
    exp = {r.g: (*r.q, r.m) for r in ref.collect()}
    assert got == exp


def test_hot_record_is_exact_and_spread_over_partitions(spark):
    # one record holds 6000 of 6300 rows
    df = spark.range(0, 6300).selectExpr(
        "CASE WHEN id < 6000 THEN 0 ELSE 1 + id % 10 END AS rec", "CAST(id AS DOUBLE) AS t", "cos(id / 7.0) AS x")
    seg = segmented(df, ["rec"], ["t"], rows=300, position="pos", lags={"x": [1]}, running={"x": "cx"})
    out = seg.withColumn("part", F.spark_partition_id())
    hot = out.where("rec = 0")
    assert hot.select("part").distinct().count() > 1  # the hot record is not one task
    ref = plain(df.withColumn("id", F.col("t").cast("long")).withColumn("z", F.lit(0.0)))
    got = {r.id: (r.pos, r.lag1_x, r.cx) for r in seg.withColumn("id", F.col("t").cast("long")).collect()}
    for r in ref.collect():
        g = got[r.id]
        assert g[0] == r.pos and (g[1] is None) == (r.lag1_x is None)
        assert abs(g[2] - r.cx) < 1e-6


def test_time_windows_tumbling_and_sliding(spark):
    import datetime as dt

    from curatio.operators.windows import time_windows

    base = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(i, base + dt.timedelta(seconds=10 * i)) for i in range(12)], "i int, ts timestamp")
    tum = time_windows(df, "ts", "1 minute").groupBy("window_id").count().orderBy("window_id").collect()
    assert [r["count"] for r in tum] == [6, 6]
    sl = time_windows(df, "ts", "1 minute", "30 seconds").groupBy("window_id").count().collect()
    assert sum(r["count"] for r in sl) == 24


def test_null_record_and_null_order_equal_the_plain_window(spark):
    rows = [(r, t, i, 10 * i) for i, (r, t) in enumerate(
        [(None, 1.0), (None, 2.0), (None, 9.0), ("a", None), ("a", 0.5), ("a", 7.0), (None, None), ("b", 3.0)])]
    df = spark.createDataFrame(rows, "r string, t double, id int, v bigint")
    kw = dict(position="p", length="n", lags={"v": [1]}, leads={"v": [1]}, running={"v": "cum"}, totals={"v": "tot"})
    plain = segmented(df, ["r"], ["t", "id"], bounded=True, **kw)
    for rows in (1, 3, None):
        cut = segmented(df, ["r"], ["t", "id"], rows=rows, **kw).select(plain.columns)
        assert dict(cut.dtypes) == dict(plain.dtypes)
        assert sorted(cut.collect(), key=lambda x: x.id) == sorted(plain.collect(), key=lambda x: x.id)


def test_windows_cover_the_tail(spark):
    from curatio.operators.windows import fixed_windows

    df = spark.range(70).selectExpr("'a' AS r", "id AS i").unionByName(spark.range(5).selectExpr("'b' AS r", "id AS i"))
    got = fixed_windows(df, ["r"], ["i"], 32, 16, rows=10).groupBy("r", "window_id").count().collect()
    assert {(x.r, x.window_id): x["count"] for x in got} == {("a", 0): 32, ("a", 1): 32, ("a", 2): 32, ("a", 3): 22, ("b", 0): 5}


def test_dfa_keeps_short_and_flat_records(spark):
    from curatio.sensors.fractal import dfa

    df = spark.range(40).selectExpr("'flat' AS r", "id AS t", "1.0D AS v").unionByName(
        spark.range(7).selectExpr("'short' AS r", "id AS t", "id * 1.0D AS v")).unionByName(
        spark.range(64).selectExpr("CAST(NULL AS string) AS r", "id AS t", "sin(id * id) AS v"))
    got = {x.r: x.dfa for x in dfa(df, ["r"], ["t"], rows=9).collect()}
    assert set(got) == {"flat", "short", None}
    assert got["flat"] is None and got["short"] is None and got[None] is not None


def test_same_keys_meets_null_keys(spark):
    from curatio.operators.joins import same_keys

    a = spark.createDataFrame([(None, 1), ("x", 2), ("y", 3)], "k string, a int")
    b = spark.createDataFrame([(None, 10), ("x", 20)], "k string, b int")
    got = {r.k: (r.a, r.b) for r in same_keys(a, b, ["k"]).collect()}
    assert got == {None: (1, 10), "x": (2, 20), "y": (3, None)}


def test_chunks_are_cut_by_rows_with_one_hot_record_and_equal_times(spark):
    # a third of all rows is one record, all at one time; only the last order column tells its rows apart
    df = spark.range(9000).selectExpr("CASE WHEN id < 3000 THEN 0 ELSE 1 + id % 60 END AS rec",
                                      "CASE WHEN id < 3000 THEN 5.0D ELSE CAST(id AS DOUBLE) END AS t", "id", "sin(id) AS x")
    cut = spread(df, ["rec", "t", "id"], 300)
    sizes = [r["count"] for r in cut.groupBy("rec", "__chunk").count().collect()]
    assert max(sizes) <= 600 and max(r["count"] for r in cut.groupBy("__chunk").count().collect()) <= 600
    assert cut.where("rec = 0").select("__chunk").distinct().count() >= 5
    seg = segmented(cut, ["rec"], ["t", "id"], position="pos", lags={"x": [1]})
    got = {r.id: (r.pos, r.lag1_x) for r in seg.where("rec = 0").collect()}
    x = {r.id: r.x for r in df.where("rec = 0").collect()}
    assert got == {i: (i, x.get(i - 1)) for i in range(3000)}
    # the frame that was spread once serves further calls
    more = segmented(seg.select("rec", "t", "id", "pos", "__chunk"), ["rec"], ["t", "id"], length="n", running={"pos": "c"})
    hot = more.where("rec = 0 AND id = 2999").first()
    assert hot.n == 3000 and hot.c == 2999 * 3000 // 2


def test_quantiles_of_a_narrow_range_are_spread(spark):
    from curatio.operators.quantiles import group_quantiles

    df = spark.range(4000).selectExpr("0 AS g", "0.5D + (id * 7919 % 4000) / 1e9D AS v")
    cells = spread(df, ["g", "v"], 200).groupBy("__chunk").count().collect()
    assert len(cells) >= 10 and max(r["count"] for r in cells) <= 400
    got = group_quantiles(df, ["g"], "v", [0.0, 0.25, 0.5, 1.0], ["lo", "q1", "md", "hi"], rows=200).first()
    ref = df.agg(F.percentile("v", [0.0, 0.25, 0.5, 1.0]).alias("q")).first().q
    assert [got.lo, got.q1, got.md, got.hi] == ref and got["mode"] == 0.5


def brute_dfa(x, min_box=4):
    """Residuals of a line through every box, box by box."""
    y, n, sizes, f = np.cumsum(x - np.mean(x)), len(x), [], []
    size = min_box
    while size <= n // 4:
        k, msq = np.arange(size), []
        for b in range(n // size):
            box = y[b * size : (b + 1) * size]
            msq.append(np.mean((box - np.polyval(np.polyfit(k, box, 1), k)) ** 2))
        sizes.append(size)
        f.append(np.sqrt(np.mean(msq)))
        size *= 2
    return np.polyfit(np.log(sizes), np.log(f), 1)[0]


@pytest.mark.parametrize("block", [2, 8, 4096])
def test_dfa_merges_boxes_like_brute_force(spark, block):
    from curatio.sensors import fractal

    r = np.random.default_rng(3)
    # a large mean must not cost digits
    series = {"a": r.normal(size=1000), "b": 1e6 + r.normal(size=317), "c": r.normal(size=64).cumsum(), "d": r.normal(size=35)}
    df = spark.createDataFrame([(k, i, float(v)) for k, x in series.items() for i, v in enumerate(x)], "r string, t int, v double")
    got = {x.r: x.dfa for x in fractal.dfa(df, ["r"], ["t"], rows=100, block=block).collect()}
    for k, x in series.items():
        assert abs(got[k] - brute_dfa(x)) < 1e-6, k


def test_dfa_has_a_row_a_smallest_box_and_no_copies(spark):
    from curatio.sensors import fractal

    df = spark.range(1000).selectExpr("id % 2 AS r", "id AS t", "sin(id) AS v")
    seen = []
    keep = fractal.written
    fractal.written = lambda d, *a: (seen.append(d), keep(d, *a))[1]
    try:
        fractal.dfa(df, ["r"], ["t"]).collect()
    finally:
        fractal.written = keep
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan
