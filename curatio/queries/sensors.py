"""Registered sensor-feature queries (SURVEY group N) with DuckDB oracles.

Stand-in series (shape only, no feature work):
* taps   — ``events``: record = user, ordered by (ts, event_id), t = epoch
  seconds, x = value, y = props.k, button from the event type;
* walk   — ``lineitem``: record = supplier, ordered by (ship date, order,
  line, part), X = quantity, Y = price / 1000, Z = discount * 100,
  t = days since 1995-01-01;
* tremor — ``embeddings``: record = vector, samples = array positions at
  100 Hz, individual = label.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curatio.functions.expr import epoch_seconds
from curatio.operators.reshape import unpivot
from curatio.operators.segmented import by_length, segmented, spread
from curatio.operators.windows import fixed_windows
from curatio.queries.common import present, present_sql, table
from curatio.sensors import activities as AC
from curatio.sensors import features as FT
from curatio.sensors import series as SR
from curatio.sensors import spectral as SP
from curatio.sensors.fractal import dfa
from curatio.sensors.periodogram import lomb_scargle_peak
from curatio.session import bucketed, scratch

QUERIES: dict = {}
ORACLE: dict = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def rounded(df: DataFrame, keep: list[str], digits: int = 6) -> DataFrame:
    """Round every non-key numeric column for presentation (same rule as the oracle)."""
    types = dict(df.dtypes)
    cols = []
    for n in df.columns:
        if n not in keep and types[n] in ("double", "float"):
            cols.append(present(F.col(f"`{n}`"), digits).alias(n))
        else:
            cols.append(F.col(f"`{n}`"))
    return df.select(*cols)


def rsql(expr: str, alias: str, digits: int | None = 6) -> str:
    """``expr`` rounded for presentation, or as it is."""
    return f"{expr if digits is None else present_sql(expr, digits)} AS {alias}"


# --------------------------------------------------------------------------
# stand-in series
# --------------------------------------------------------------------------

BUTTON = "CASE event_type WHEN 'click' THEN 'left' WHEN 'view' THEN 'right' ELSE 'none' END"


def taps(spark, d) -> DataFrame:
    ev = table(spark, d, "events")
    return ev.select(
        F.col("user_id").alias("record_id"), "event_id", "ts", epoch_seconds("ts").alias("t"),
        F.col("value").alias("x"), F.get_json_object("props", "$.k").cast("double").alias("y"),
        F.expr(BUTTON).alias("button"),
    )


TAPS_DUCK = (
    "SELECT user_id AS record_id, event_id, ts, epoch_us(ts) / 1e6 AS t, value AS x, "
    f"CAST(json_extract_string(props, '$.k') AS DOUBLE) AS y, {BUTTON} AS button FROM events"
)
TAP_ORDER = ["ts", "event_id"]
TAP_ORDER_SQL = "ts, event_id"
TAPINTER_DUCK = (
    f"SELECT record_id, event_id, ts, t - lag(t) OVER (PARTITION BY record_id ORDER BY {TAP_ORDER_SQL}) AS v "
    f"FROM ({TAPS_DUCK}) QUALIFY v IS NOT NULL"
)
DRIFT_DUCK = (
    "SELECT record_id, event_id, ts, button, sqrt(pow(x - lag(x) OVER w, 2) + pow(y - lag(y) OVER w, 2)) AS v "
    f"FROM ({TAPS_DUCK}) WHERE button <> 'none' WINDOW w AS (PARTITION BY record_id, button ORDER BY {TAP_ORDER_SQL}) "
    "QUALIFY v IS NOT NULL"
)
TAP_SERIES_DUCK = (
    f"SELECT record_id, 'TapInter' AS series, event_id, ts, v FROM ({TAPINTER_DUCK}) UNION ALL "
    f"SELECT record_id, CASE button WHEN 'left' THEN 'DriftLeft' ELSE 'DriftRight' END, event_id, ts, v FROM ({DRIFT_DUCK})"
)


def tap_series(spark, d) -> DataFrame:
    """Long frame (record_id, series, event_id, ts, v) of TapInter, DriftLeft, DriftRight."""
    tp = taps(spark, d)
    inter = SR.tap_intervals(tp, ["record_id"], TAP_ORDER, "t", "v").select(
        "record_id", F.lit("TapInter").alias("series"), "event_id", "ts", "v")
    drift = SR.button_drift(tp, ["record_id"], TAP_ORDER, "button", "x", "y", "v").select(
        "record_id",
        F.when(F.col("button") == "left", "DriftLeft").otherwise("DriftRight").alias("series"),
        "event_id", "ts", "v",
    )
    return inter.unionByName(drift)


def walk(spark, d) -> DataFrame:
    li = table(spark, d, "lineitem")
    return li.select(
        F.col("l_suppkey").alias("record_id"), "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey",
        F.col("l_quantity").alias("X"), (F.col("l_extendedprice") / F.lit(1000.0)).alias("Y"),
        (F.col("l_discount") * F.lit(100.0)).alias("Z"),
        F.datediff(F.to_date("l_shipdate"), F.lit("1995-01-01").cast("date")).cast("double").alias("t"),
    )


WALK_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"]
WALK_ORDER_SQL = ", ".join(WALK_ORDER)
WALK_DUCK = (
    "SELECT l_suppkey AS record_id, l_shipdate, l_orderkey, l_linenumber, l_partkey, l_quantity AS X, "
    "l_extendedprice / 1000.0 AS Y, l_discount * 100.0 AS Z, "
    "CAST(datediff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) AS DOUBLE) AS t FROM lineitem"
)
WALK_AXES_DUCK = (
    f"SELECT *, sqrt(X * X + Y * Y + Z * Z) AS AA, sqrt(pow(X - lag(X) OVER w, 2) + pow(Y - lag(Y) OVER w, 2) "
    f"+ pow(Z - lag(Z) OVER w, 2)) AS AJ FROM ({WALK_DUCK}) WINDOW w AS (PARTITION BY record_id ORDER BY {WALK_ORDER_SQL})"
)
WALK_LONG_DUCK = (
    f"SELECT record_id, {WALK_ORDER_SQL}, t, axis, v FROM ({WALK_AXES_DUCK}) "
    "UNPIVOT (v FOR axis IN (X, Y, Z, AA, AJ))"
)


def walk_axes(w: DataFrame, bounded: bool) -> DataFrame:
    w = w.withColumn("AA", SR.magnitude(["X", "Y", "Z"]))
    return SR.with_jerk(w, ["record_id"], WALK_ORDER, ["X", "Y", "Z"], "AJ", bounded=bounded)


def walk_long(w: DataFrame, bounded: bool) -> DataFrame:
    """(record_id, order..., t, axis, v) for the axes X, Y, Z, AA, AJ; AJ's first sample has no value."""
    long = unpivot(walk_axes(w, bounded), ["record_id", *WALK_ORDER, "t"], ["X", "Y", "Z", "AA", "AJ"], "axis", "v", in_place=True)
    return long.where(F.col("v").isNotNull())


def of_walks(spark, d, stats) -> DataFrame:
    """``stats(long, bounded)`` of the long frames of all records."""
    return by_length(walk(spark, d), ["record_id"], lambda w, bounded: stats(walk_long(w, bounded), bounded))


FS = 100.0


def tremor(spark, d) -> DataFrame:
    e = table(spark, d, "embeddings")
    return e.select("vec_id", "label", F.posexplode("embedding").alias("i", "ua")).withColumn(
        "ua", F.col("ua").cast("double"))


TREMOR_DUCK = (
    "SELECT vec_id, label, CAST(unnest(range(len(embedding))) AS INTEGER) AS i, "
    "CAST(unnest(embedding) AS DOUBLE) AS ua FROM embeddings"
)
TREMOR_AXES_DUCK = f"""
SELECT vec_id, label, i, ua, uv, sum(uv) OVER (PARTITION BY vec_id ORDER BY i ROWS UNBOUNDED PRECEDING) * {1 / FS!r} AS ud, uj
FROM (SELECT *, sum(ua) OVER (PARTITION BY vec_id ORDER BY i ROWS UNBOUNDED PRECEDING) * {1 / FS!r} AS uv,
             (ua - lag(ua) OVER (PARTITION BY vec_id ORDER BY i)) * {FS!r} AS uj FROM ({TREMOR_DUCK}))
"""
WIN, STEP = 32, 16
TREMOR_WIN_DUCK = f"""
SELECT * FROM (SELECT t.*, CAST(unnest(range(0, CAST(greatest(floor((n - {WIN}) / {STEP}) + 1, 1) AS BIGINT))) AS INTEGER) AS window_id
  FROM (SELECT *, count(*) OVER (PARTITION BY vec_id) AS n FROM ({TREMOR_AXES_DUCK})) t)
WHERE i >= window_id * {STEP} AND i < window_id * {STEP} + {WIN}
"""
TREMOR_LONG_DUCK = (
    f"SELECT vec_id, label, window_id, i, axis, v FROM ({TREMOR_WIN_DUCK}) "
    "UNPIVOT (v FOR axis IN (ua, uv, ud, uj)) "
)


T_KEYS = ["vec_id", "window_id", "axis"]
T_KEYS_SQL = "vec_id, window_id, axis"


def tremor_axes(spark, d) -> DataFrame:
    return SR.derived_axes(spread(tremor(spark, d), ["vec_id", "i"]), ["vec_id"], ["i"], "ua", FS)


def tremor_long(spark, d) -> DataFrame:
    """(vec_id, label, window_id, i, axis, v): derived axes cut into 32-sample windows, 50 % overlap."""
    win = fixed_windows(tremor_axes(spark, d), ["vec_id"], ["i"], WIN, STEP)
    long = unpivot(win, ["vec_id", "label", "window_id", "i"], ["ua", "uv", "ud", "uj"], "axis", "v")
    return long.where(F.col("v").isNotNull())


# --------------------------------------------------------------------------
# oracle SQL builders for the shared statistics
# --------------------------------------------------------------------------


def sql_moments(src: str, keys: str, digits: int | None = 6) -> str:
    return f"""
SELECT {keys}, count(v) AS n, {rsql('avg(v)', 'mean', digits=digits)}, {rsql('stddev_samp(v)', 'sd', digits=digits)},
  {rsql('CASE WHEN avg(c * c) > 0 THEN avg(c * c * c) / pow(avg(c * c), 1.5) END', 'skew', digits=digits)},
  {rsql('CASE WHEN avg(c * c) > 0 THEN avg(c * c * c * c) / pow(avg(c * c), 2) - 3 END', 'kur', digits=digits)},
  {rsql('min(v)', '"min"', digits=digits)}, {rsql('max(v)', '"max"', digits=digits)}, {rsql('max(v) - min(v)', '"range"', digits=digits)},
  {rsql('CASE WHEN avg(v) <> 0 THEN stddev_samp(v) / avg(v) END', 'cv', digits=digits)},
  {rsql('sum(v * v)', 'energy', digits=digits)}, {rsql('sqrt(avg(v * v))', 'rmsmag', digits=digits)}
FROM (SELECT *, v - avg(v) OVER (PARTITION BY {keys}) AS c FROM ({src})) GROUP BY {keys}"""


def sql_q(lst: str, p: float) -> str:
    """Type-7 quantile of a sorted list, interpolated exactly as Spark's
    ``percentile`` does: ``(hi - pos) * x[lo] + (pos - lo) * x[hi]``."""
    pos = f"((len({lst}) - 1) * {p!r})"
    return (
        f"(CASE WHEN floor({pos}) = ceil({pos}) THEN {lst}[CAST({pos} AS BIGINT) + 1] "
        f"ELSE (ceil({pos}) - {pos}) * {lst}[CAST(floor({pos}) AS BIGINT) + 1] "
        f"+ ({pos} - floor({pos})) * {lst}[CAST(ceil({pos}) AS BIGINT) + 1] END)"
    )


def sql_quantiles(src: str, keys: str, digits: int | None = 6) -> str:
    return f"""
SELECT q.*, m."mode" FROM (
  SELECT {keys}, {rsql(sql_q('l', 0.25), 'q1', digits=digits)}, {rsql(sql_q('l', 0.5), 'median', digits=digits)},
         {rsql(sql_q('l', 0.75), 'q3', digits=digits)}, {rsql(sql_q('l', 0.75) + ' - ' + sql_q('l', 0.25), 'iqr', digits=digits)}
  FROM (SELECT {keys}, list(v ORDER BY v) FILTER (WHERE v IS NOT NULL) AS l FROM ({src}) GROUP BY {keys})) q
JOIN (SELECT {keys}, {rsql('arg_max(v, (cnt, -v))', '"mode"', digits=digits)} FROM (
        SELECT {keys}, v, count(*) AS cnt FROM ({src}) WHERE v IS NOT NULL GROUP BY ALL) GROUP BY {keys}) m
USING ({keys})"""


def sql_order_stats(src: str, keys: str, order: str, fs: float = 1.0, digits: int | None = 6) -> str:
    return f"""
SELECT {keys},
  {rsql('CASE WHEN sum(c * c) <> 0 THEN sum(c * c1) / sum(c * c) END', 'acf1', digits=digits)},
  {rsql('CASE WHEN sum(c * c) <> 0 THEN sum(c * c2) / sum(c * c) END', 'acf2', digits=digits)},
  {rsql('CASE WHEN count(cp) > 0 THEN sum(CASE WHEN c * cp < 0 THEN 1.0 ELSE 0.0 END) / count(cp) END', 'zcr', digits=digits)},
  {rsql('avg(tk)', 'tkeo', digits=digits)}, {rsql('avg(abs(c))', 'mad', digits=digits)},
  {rsql('sqrt(CASE WHEN var_samp(x) <> 0 THEN var_samp(d1) / var_samp(x) END)', 'mobility', digits=digits)},
  {rsql('sqrt(CASE WHEN var_samp(d1) <> 0 THEN var_samp(d2) / var_samp(d1) END)', 'complexity', digits=digits)},
  {rsql(f'sum(d2 * d2 / {fs ** 4!r})', 'rough', digits=digits)}, {rsql('sqrt(avg(dx * dx))', 'rugo', digits=digits)}
FROM (
  SELECT {keys}, v - m AS c, lag(v) OVER w - m AS cp, lead(v) OVER w - m AS c1, lead(v, 2) OVER w - m AS c2,
         v * v - lag(v) OVER w * lead(v) OVER w AS tk, (v - lag(v) OVER w) * {fs!r} AS d1,
         (v - 2.0 * lag(v) OVER w + lag(v, 2) OVER w) * {fs * fs!r} AS d2, v - lag(v) OVER w AS dx, v AS x
  FROM (SELECT *, avg(v) OVER (PARTITION BY {keys}) AS m FROM ({src}))
  WINDOW w AS (PARTITION BY {keys} ORDER BY {order}))
GROUP BY {keys}"""


def sql_dfa(src: str, keys: str, order: str, min_box: int = 4, digits: int | None = 6) -> str:
    return f"""
WITH p AS (
  SELECT {keys}, k, len_ AS N_, sum(c) OVER (PARTITION BY {keys} ORDER BY k ROWS UNBOUNDED PRECEDING) AS y FROM (
    SELECT {keys}, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) - 1 AS k,
           count(*) OVER (PARTITION BY {keys}) AS len_, v - avg(v) OVER (PARTITION BY {keys}) AS c
    FROM ({src}) WHERE v IS NOT NULL)),
b AS (
  SELECT {keys}, bs, floor(k / bs) AS b, y, k FROM (
    SELECT *, CAST(pow(2, unnest(range({min_box.bit_length() - 1}, CAST(greatest({min_box.bit_length() - 1}, floor(log2(N_ / 4.0))) AS BIGINT) + 1))) AS INTEGER) AS bs
    FROM p WHERE N_ >= {4 * min_box})
  WHERE floor(k / bs) < floor(N_ / bs)),
bx AS (SELECT {keys}, bs, b, regr_syy(y, k) - CASE WHEN regr_sxx(y, k) <> 0 THEN regr_sxy(y, k) * regr_sxy(y, k) / regr_sxx(y, k) END AS rss,
              count(*) AS m FROM b GROUP BY ALL),
fn AS (SELECT {keys}, bs, sqrt(avg(greatest(rss, 0.0) / m)) AS fl FROM bx GROUP BY ALL
       UNION ALL SELECT DISTINCT {keys}, NULL, NULL FROM p)
SELECT {keys}, {rsql('regr_slope(CASE WHEN fl > 0 THEN ln(fl) END, CASE WHEN fl > 0 THEN ln(CAST(bs AS DOUBLE)) END)', 'dfa', digits)} FROM fn GROUP BY {keys}"""


def sql_lomb(src: str, keys: str, f_min: float, f_max: float, n_freq: int, digits: int | None = 6) -> str:
    step = (f_max - f_min) / (n_freq - 1)
    return f"""
WITH s AS (
  SELECT {keys}, fk, {f_min!r} + fk * {step!r} AS f, count(*) AS n, sum(v) AS Y, sum(v * v) AS YY,
         sum(cos(wt)) AS C, sum(sin(wt)) AS S, sum(v * cos(wt)) AS YC, sum(v * sin(wt)) AS YS,
         sum(cos(wt) * cos(wt)) AS CC, sum(sin(wt) * sin(wt)) AS SS, sum(cos(wt) * sin(wt)) AS CS
  FROM (SELECT x.*, g.fk, {2 * 3.141592653589793!r} * ({f_min!r} + g.fk * {step!r}) * t AS wt
        FROM ({src}) x, range({n_freq}) g(fk) WHERE v IS NOT NULL AND t IS NOT NULL)
  GROUP BY ALL),
m AS (SELECT *, Y / n AS mu, CASE WHEN n > 1 THEN (YY - n * (Y / n) * (Y / n)) / (n - 1) END AS var,
             atan2(2.0 * CS, CC - SS) / 2 AS tau FROM s),
q AS (SELECT *, cos(tau) AS ct, sin(tau) AS sn, YC - mu * C AS ycc, YS - mu * S AS ysc FROM m),
p AS (SELECT {keys}, fk, f, CASE WHEN var > 0 THEN (
        coalesce(CASE WHEN (ct*ct*CC + 2.0*ct*sn*CS + sn*sn*SS) > 1e-9 * n THEN pow(ct*ycc + sn*ysc, 2) / (ct*ct*CC + 2.0*ct*sn*CS + sn*sn*SS) END, 0.0)
      + coalesce(CASE WHEN (ct*ct*SS - 2.0*ct*sn*CS + sn*sn*CC) > 1e-9 * n THEN pow(ct*ysc - sn*ycc, 2) / (ct*ct*SS - 2.0*ct*sn*CS + sn*sn*CC) END, 0.0)
      ) / (2.0 * var) END AS power FROM q)
SELECT {keys}, {rsql('arg_max(f, (power, -fk)) FILTER (WHERE power IS NOT NULL)', 'F0', digits)}, {rsql('max(power)', 'P0', digits)}
FROM p GROUP BY {keys}"""


# --------------------------------------------------------------------------
# N-prep
# --------------------------------------------------------------------------


@query(
    "avg_acceleration",
    f"SELECT record_id, l_orderkey, l_linenumber, l_partkey, {rsql('sqrt(X * X + Y * Y + Z * Z)', 'AA')} FROM ({WALK_DUCK})",
)
def avg_acceleration(spark, d):
    w = walk(spark, d).withColumn("AA", SR.magnitude(["X", "Y", "Z"]))
    return rounded(w.select("record_id", "l_orderkey", "l_linenumber", "l_partkey", "AA"), ["record_id"])


@query(
    "avg_jerk",
    f"SELECT record_id, l_orderkey, l_linenumber, l_partkey, {rsql('AJ', 'AJ')} FROM ({WALK_AXES_DUCK})",
)
def avg_jerk(spark, d):
    w = SR.with_jerk(walk(spark, d), ["record_id"], WALK_ORDER, ["X", "Y", "Z"], "AJ")
    return rounded(w.select("record_id", "l_orderkey", "l_linenumber", "l_partkey", "AJ"), ["record_id"])


@query("tap_interval", f"SELECT record_id, event_id, {rsql('v', 'interval', 4)} FROM ({TAPINTER_DUCK})")
def tap_interval(spark, d):
    out = SR.tap_intervals(taps(spark, d), ["record_id"], TAP_ORDER, "t", "interval")
    return rounded(out.select("record_id", "event_id", "interval"), ["record_id"], 4)


@query("button_drift", f"SELECT record_id, event_id, button, {rsql('v', 'drift')} FROM ({DRIFT_DUCK})")
def button_drift(spark, d):
    out = SR.button_drift(taps(spark, d), ["record_id"], TAP_ORDER, "button", "x", "y", "drift")
    return rounded(out.select("record_id", "event_id", "button", "drift"), ["record_id"])


@query(
    "derived_axes",
    f"SELECT vec_id, i, {rsql('uv', 'uv')}, {rsql('ud', 'ud')}, {rsql('uj', 'uj', 4)} FROM ({TREMOR_AXES_DUCK})",
)
def derived_axes(spark, d):
    a = tremor_axes(spark, d)
    return a.select("vec_id", "i", present(F.col("uv")).alias("uv"), present(F.col("ud")).alias("ud"),
                    present(F.col("uj"), 4).alias("uj"))


@query(
    "acf_series",
    f"""
SELECT record_id, lag, {rsql('CASE WHEN s0 <> 0 THEN s / s0 END', 'acf')} FROM (
  SELECT record_id, g.lag, sum(c * CASE g.lag WHEN 0 THEN c WHEN 1 THEN c1 WHEN 2 THEN c2 WHEN 3 THEN c3 END) AS s,
         sum(c * c) AS s0
  FROM (SELECT record_id, c, lead(c) OVER w AS c1, lead(c, 2) OVER w AS c2, lead(c, 3) OVER w AS c3
        FROM (SELECT *, x - avg(x) OVER (PARTITION BY record_id) AS c FROM ({TAPS_DUCK}))
        WINDOW w AS (PARTITION BY record_id ORDER BY {TAP_ORDER_SQL})), range(4) g(lag)
  GROUP BY record_id, g.lag)
""",
)
def acf_series(spark, d):
    out = SR.acf_series(taps(spark, d), ["record_id"], TAP_ORDER, "x", 3)
    return out.select("record_id", F.col("lag").cast("bigint").alias("lag"), present(F.col("acf")).alias("acf"))


@query(
    "sensor_split",
    "SELECT vec_id, CAST(unnest(range(len(embedding))) AS INTEGER) AS i, CAST(unnest(embedding) AS DOUBLE) AS value, "
    "CASE WHEN label < 5 THEN 'accelerometer' ELSE 'gyroscope' END AS sensor FROM embeddings",
)
def sensor_split(spark, d):
    """Write the waveforms partitioned by sensor type and read each sensor back from its partition."""
    t = tremor(spark, d).withColumn("sensor", F.when(F.col("label") < 5, "accelerometer").otherwise("gyroscope"))
    path = scratch(spark, "sensor-split")
    t.select("vec_id", "i", F.col("ua").alias("value"), "sensor").write.partitionBy("sensor").parquet(path)
    back = [spark.read.parquet(path).where(F.col("sensor") == s) for s in ("accelerometer", "gyroscope")]
    return back[0].unionByName(back[1]).select("vec_id", "i", "value", "sensor")


# --------------------------------------------------------------------------
# spectral (FFT has a DFT oracle; EMD and EWT have none)
# --------------------------------------------------------------------------

SPEC_DUCK = f"""
SELECT vec_id, window_id, axis, CAST(g.k AS INTEGER) AS bin, g.k * {FS!r} / n AS freq,
       (pow(sum(c * cos(2 * pi() * g.k * j / n)), 2) + pow(sum(c * sin(2 * pi() * g.k * j / n)), 2)) / n AS power
FROM (SELECT vec_id, window_id, axis, v - avg(v) OVER w AS c,
             row_number() OVER (PARTITION BY vec_id, window_id, axis ORDER BY i) - 1 AS j, count(*) OVER w AS n
      FROM ({TREMOR_LONG_DUCK}) WINDOW w AS (PARTITION BY vec_id, window_id, axis)) x, range(0, {WIN // 2 + 1}) g(k)
WHERE g.k <= n // 2 GROUP BY vec_id, window_id, axis, g.k, n
"""


def tremor_spectrum(spark, d) -> DataFrame:
    return SP.spectrum(tremor_long(spark, d), T_KEYS, "i", "v", FS)


# jerk has powers of 10^4, so fewer decimals survive a different summation order
@query("spectrum_fft", f"SELECT vec_id, window_id, axis, bin, {rsql('freq', 'freq')}, {rsql('power', 'power', 4)} FROM ({SPEC_DUCK})")
def spectrum_fft(spark, d):
    s = tremor_spectrum(spark, d)
    return s.select(*T_KEYS, "bin", present(F.col("freq")).alias("freq"), present(F.col("power"), 4).alias("power"))


@query("emd_imf")
def emd_imf(spark, d):
    """Intrinsic mode functions per tremor window (no SQL form)."""
    return SP.emd(tremor_long(spark, d), T_KEYS, "i", "v")


@query(
    "emd_properties",
    "SELECT vec_id, window_id, axis, count(*) AS samples, TRUE AS adds_up, TRUE AS rest_is_slow, TRUE AS converged "
    f"FROM ({TREMOR_LONG_DUCK}) WHERE v IS NOT NULL GROUP BY ALL",
)
def emd_properties(spark, d):
    """What every decomposition has to fulfil: modes and residue add up to the input, the residue has fewer than two
    maxima or two minima, and the sifting of all modes came to its end."""
    long = tremor_long(spark, d)
    parts = SP.emd(long, T_KEYS, "i", "v", residue=True)
    at = Window.partitionBy(*T_KEYS, "imf").orderBy("i")
    before, after = F.col("value") - F.lag("value").over(at), F.lead("value").over(at) - F.col("value")
    parts = parts.withColumns({"up": (before > 0) & (after < 0), "down": (before < 0) & (after > 0)})
    rest = F.col("imf") == 0
    ends = parts.groupBy(*T_KEYS).agg(
        F.count(F.when(rest, 1)).alias("samples"),
        ((F.count(F.when(rest & F.col("up"), 1)) < 2) | (F.count(F.when(rest & F.col("down"), 1)) < 2)).alias("rest_is_slow"),
        F.min("converged").alias("converged"))
    back = parts.groupBy(*T_KEYS, "i").agg(F.sum("value").alias("sum"))
    place = long.withColumn("i", F.row_number().over(Window.partitionBy(*T_KEYS).orderBy("i")) - 1)
    off = F.abs(F.col("sum") - F.col("v")) <= 1e-9 * (1 + F.abs("v"))
    same = place.join(back, [*T_KEYS, "i"], "left").groupBy(*T_KEYS).agg(F.min(F.coalesce(off, F.lit(False))).alias("adds_up"))
    return ends.join(same, T_KEYS).select(*T_KEYS, "samples", "adds_up", "rest_is_slow", "converged")


@query(
    "emd_reconstruction",
    "SELECT vec_id, window_id, axis, CAST(row_number() OVER (PARTITION BY vec_id, window_id, axis ORDER BY i) - 1 AS INTEGER) AS i, "
    + rsql("v", "value") + f" FROM ({TREMOR_LONG_DUCK}) WHERE v IS NOT NULL",
)
def emd_reconstruction(spark, d):
    """All modes and the residue of a tremor window add up to its input."""
    parts = SP.emd(tremor_long(spark, d), T_KEYS, "i", "v", residue=True)
    keys = [*T_KEYS, "i"]
    return rounded(parts.groupBy(*keys).agg(F.sum("value").alias("value")), keys)


def _rise(w: str, b: str) -> str:
    """Squared Meyer transition (0 -> 1) around boundary ``b`` (SQL)."""
    x = f"(({w}) - (1 - gamma) * ({b})) / (2 * gamma * ({b}))"
    beta = f"(pow({x}, 4) * (35 - 84 * {x} + 70 * pow({x}, 2) - 20 * pow({x}, 3)))"
    return (f"(CASE WHEN ({w}) <= (1 - gamma) * ({b}) THEN 0.0 WHEN ({w}) >= (1 + gamma) * ({b}) THEN 1.0 "
            f"ELSE pow(sin(pi() / 2 * {beta}), 2) END)")


NB = WIN // 2 + 1  # rfft bins of a full window
EWT_DUCK = f"""
WITH x AS (
  SELECT vec_id, window_id, axis, v - avg(v) OVER (PARTITION BY vec_id, window_id, axis) AS c,
         row_number() OVER (PARTITION BY vec_id, window_id, axis ORDER BY i) - 1 AS j,
         count(*) OVER (PARTITION BY vec_id, window_id, axis) AS n
  FROM ({TREMOR_LONG_DUCK})),
spec AS (
  SELECT vec_id, window_id, axis, g.k, sum(c * cos(2 * pi() * g.k * j / n)) AS re, sum(c * sin(2 * pi() * g.k * j / n)) AS im
  , any_value(n) AS n FROM x, range(0, {NB}) g(k) WHERE g.k <= n // 2 AND n > 1 GROUP BY vec_id, window_id, axis, g.k),
s2 AS (SELECT vec_id, window_id, axis, k, n, re * re + im * im AS p, sqrt(re * re + im * im) AS mag,
              2 * pi() * k / n AS w FROM spec),
pk AS (SELECT *, lag(mag) OVER wd AS ml, lead(mag) OVER wd AS mr FROM s2
       WINDOW wd AS (PARTITION BY vec_id, window_id, axis ORDER BY k)),
top AS (SELECT * FROM (
          SELECT vec_id, window_id, axis, k, w, row_number() OVER (PARTITION BY vec_id, window_id, axis ORDER BY mag DESC, k) AS r
          FROM pk WHERE k > 0 AND k < n // 2 AND mag > ml AND mag >= mr) WHERE r <= 5),
tb AS (SELECT vec_id, window_id, axis, k, w, lead(w) OVER (PARTITION BY vec_id, window_id, axis ORDER BY k) AS wn,
              count(*) OVER (PARTITION BY vec_id, window_id, axis) AS m FROM top),
bnd AS (SELECT vec_id, window_id, axis, m, (w + wn) / 2 AS b,
               row_number() OVER (PARTITION BY vec_id, window_id, axis ORDER BY k) AS bi FROM tb WHERE wn IS NOT NULL AND m >= 2),
gam AS (SELECT vec_id, window_id, axis, any_value(m) AS m,
               0.9 * min((coalesce(nb, pi()) - b) / (coalesce(nb, pi()) + b)) AS gamma
        FROM (SELECT *, lead(b) OVER (PARTITION BY vec_id, window_id, axis ORDER BY bi) AS nb FROM bnd) GROUP BY vec_id, window_id, axis),
comp AS (SELECT s2.vec_id, s2.window_id, s2.axis, s2.k, s2.p, s2.w, c.n, gam.gamma
         FROM s2 JOIN gam USING (vec_id, window_id, axis) CROSS JOIN range(0, 5) c(n) WHERE c.n < gam.m),
wts AS (SELECT comp.*, lo.b AS blo, hi.b AS bhi FROM comp
        LEFT JOIN bnd lo ON lo.vec_id = comp.vec_id AND lo.window_id = comp.window_id AND lo.axis = comp.axis AND lo.bi = comp.n
        LEFT JOIN bnd hi ON hi.vec_id = comp.vec_id AND hi.window_id = comp.window_id AND hi.axis = comp.axis AND hi.bi = comp.n + 1)
SELECT vec_id, window_id, axis, CAST(n AS INTEGER) AS band,
       sum(p * (CASE WHEN blo IS NULL THEN 1.0 ELSE {_rise('w', 'blo')} END)
             * (CASE WHEN bhi IS NULL THEN 1.0 ELSE 1.0 - {_rise('w', 'bhi')} END)) AS energy
FROM wts GROUP BY vec_id, window_id, axis, n
UNION ALL
SELECT vec_id, window_id, axis, 0, sum(p) FROM s2 WHERE (vec_id, window_id, axis) NOT IN (SELECT (vec_id, window_id, axis) FROM gam)
GROUP BY vec_id, window_id, axis
"""


@query("ewt_energy", f"SELECT vec_id, window_id, axis, band, {rsql('energy', 'energy', 4)} FROM ({EWT_DUCK})")
def ewt_energy(spark, d):
    """Empirical-wavelet band energies per tremor window (Meyer-type filters over the spectral peaks)."""
    return rounded(ewt_energy_raw(spark, d), [*T_KEYS, "band"], 4)


def ewt_energy_raw(spark, d) -> DataFrame:
    return SP.ewt_energies(tremor_long(spark, d), T_KEYS, "i", "v")


# --------------------------------------------------------------------------
# tapping
# --------------------------------------------------------------------------


@query(
    "tap_basic_stats",
    f"""
SELECT m.record_id, m.series, m.n, m.mean, m.sd, m.skew, m.kur, m."min", m."max", m."range", m.cv,
       q.median, q.iqr, o.mad
FROM ({sql_moments(TAP_SERIES_DUCK, 'record_id, series')}) m
JOIN ({sql_quantiles(TAP_SERIES_DUCK, 'record_id, series')}) q USING (record_id, series)
JOIN ({sql_order_stats(TAP_SERIES_DUCK, 'record_id, series', 'ts, event_id')}) o USING (record_id, series)
""",
)
def tap_basic_stats(spark, d):
    s = tap_series(spark, d)
    keys = ["record_id", "series"]
    st = FT.series_stats(s, keys, TAP_ORDER)
    cols = ["n", "mean", "sd", "skew", "kur", "min", "max", "range", "cv", "median", "iqr", "mad"]
    return rounded(st.select(*keys, *cols), keys)


# TKEO of intervals in seconds is ~1e9 s^2: presented in whole s^2 (6 decimals would exceed the
# precision that survives a different summation order).
@query(
    "tap_tkeo",
    "SELECT record_id, " + present_sql("tkeo_raw", 0) + " AS tkeo FROM ("
    + sql_order_stats(TAP_SERIES_DUCK, "record_id, series", "ts, event_id").replace(
        f"{rsql('avg(tk)', 'tkeo')}", "avg(tk) AS tkeo_raw") + ") WHERE series = 'TapInter'",
)
def tap_tkeo(spark, d):
    s = tap_series(spark, d).where(F.col("series") == "TapInter")
    return rounded(FT.order_stats(s, ["record_id"], TAP_ORDER).select("record_id", "tkeo"),
                   ["record_id"], 0)


@query(
    "tap_autocorr",
    f"SELECT record_id, acf1 AS ar1, acf2 AS ar2 FROM ({sql_order_stats(TAP_SERIES_DUCK, 'record_id, series', 'ts, event_id')}) "
    "WHERE series = 'TapInter'",
)
def tap_autocorr(spark, d):
    s = tap_series(spark, d).where(F.col("series") == "TapInter")
    o = FT.order_stats(s, ["record_id"], TAP_ORDER)
    return rounded(o.select("record_id", F.col("acf1").alias("ar1"), F.col("acf2").alias("ar2")), ["record_id"])


@query(
    "tap_fatigue",
    f"""
WITH p AS (SELECT record_id, v, row_number() OVER (PARTITION BY record_id ORDER BY ts, event_id) AS i,
                  count(*) OVER (PARTITION BY record_id) AS n FROM ({TAPINTER_DUCK}))
SELECT record_id, """
    + ", ".join(
        rsql(f"avg(v) FILTER (WHERE i <= ceil(n * {p})) - avg(v) FILTER (WHERE i > n - ceil(n * {p}))", f"fatigue{t}", 4)
        for p, t in [(0.1, 10), (0.25, 25), (0.5, 50)]
    )
    + " FROM p GROUP BY record_id",
)
def tap_fatigue(spark, d):
    s = tap_series(spark, d).where(F.col("series") == "TapInter")
    return rounded(FT.fatigue(s, ["record_id"], TAP_ORDER), ["record_id"], 4)


@query(
    "tap_counts",
    f"SELECT record_id, count(*) AS numberTaps, {rsql('avg(CASE WHEN button = ' + chr(39) + 'none' + chr(39) + ' THEN 1.0 ELSE 0.0 END)', 'buttonNoneFreq')} "
    f"FROM ({TAPS_DUCK}) GROUP BY record_id",
)
def tap_counts(spark, d):
    tp = taps(spark, d)
    out = tp.groupBy("record_id").agg(
        F.count(F.lit(1)).alias("numberTaps"),
        F.avg(F.when(F.col("button") == "none", 1.0).otherwise(0.0)).alias("buttonNoneFreq"),
    )
    return rounded(out, ["record_id"])


@query(
    "tap_corr",
    f"SELECT record_id, {rsql('CASE WHEN stddev_pop(x) * stddev_pop(y) <> 0 THEN covar_pop(x, y) / (stddev_pop(x) * stddev_pop(y)) END', 'corXY')} "
    f"FROM ({TAPS_DUCK}) GROUP BY record_id",
)
def tap_corr(spark, d):
    out = taps(spark, d).groupBy("record_id").agg(FT.correlation("x", "y").alias("corXY"))
    return rounded(out, ["record_id"])


# --------------------------------------------------------------------------
# walking
# --------------------------------------------------------------------------

W_KEYS = ["record_id", "axis"]
W_KEYS_SQL = "record_id, axis"


@query(
    "walk_moments",
    f"SELECT record_id, axis, n, mean, sd, skew, kur, \"range\", cv FROM ({sql_moments(WALK_LONG_DUCK + ' WHERE v IS NOT NULL', W_KEYS_SQL)})",
)
def walk_moments(spark, d):
    m = of_walks(spark, d, lambda long, _: FT.moment_stats(long, W_KEYS)).select(*W_KEYS, "n", "mean", "sd", "skew", "kur", "range", "cv")
    return rounded(m, W_KEYS)


@query("walk_quantiles", sql_quantiles(WALK_LONG_DUCK + " WHERE v IS NOT NULL", W_KEYS_SQL))
def walk_quantiles(spark, d):
    return rounded(of_walks(spark, d, lambda long, bounded: FT.quantile_stats(long, W_KEYS, bounded=bounded)), W_KEYS)


@query(
    "walk_acf_zcr",
    f"SELECT record_id, axis, acf1 AS acf, zcr, tkeo FROM ({sql_order_stats(WALK_LONG_DUCK + ' WHERE v IS NOT NULL', W_KEYS_SQL, WALK_ORDER_SQL)})",
)
def walk_acf_zcr(spark, d):
    o = of_walks(spark, d, lambda long, bounded: FT.order_stats(long, W_KEYS, WALK_ORDER, bounded=bounded))
    return rounded(o.select(*W_KEYS, F.col("acf1").alias("acf"), "zcr", "tkeo"), W_KEYS)


@query("walk_dfa", sql_dfa(WALK_LONG_DUCK + " WHERE v IS NOT NULL", W_KEYS_SQL, WALK_ORDER_SQL))
def walk_dfa(spark, d):
    return rounded(of_walks(spark, d, lambda long, bounded: dfa(long, W_KEYS, WALK_ORDER, bounded=bounded)), W_KEYS)


LS_GRID = (0.01, 0.5, 50)


@query("walk_lomb_scargle", sql_lomb(WALK_LONG_DUCK + " WHERE v IS NOT NULL", W_KEYS_SQL, *LS_GRID))
def walk_lomb_scargle(spark, d):
    peaks = of_walks(spark, d, lambda long, bounded: lomb_scargle_peak(long, W_KEYS, "t", "v", *LS_GRID, bounded=bounded))
    return rounded(peaks, W_KEYS)


@query(
    "walk_corr",
    "SELECT record_id, "
    + ", ".join(
        rsql(f"CASE WHEN stddev_pop({a}) * stddev_pop({b}) <> 0 THEN covar_pop({a}, {b}) / (stddev_pop({a}) * stddev_pop({b})) END",
             f"cor{a}{b}")
        for a, b in [("X", "Y"), ("X", "Z"), ("Y", "Z")]
    )
    + f" FROM ({WALK_DUCK}) GROUP BY record_id",
)
def walk_corr(spark, d):
    w = walk(spark, d)
    out = w.groupBy("record_id").agg(*[FT.correlation(a, b).alias(f"cor{a}{b}") for a, b in [("X", "Y"), ("X", "Z"), ("Y", "Z")]])
    return rounded(out, ["record_id"])


# --------------------------------------------------------------------------
# rest (balance) on the AA series
# --------------------------------------------------------------------------

AA_DUCK = f"SELECT record_id, {WALK_ORDER_SQL}, t, AA AS v FROM ({WALK_AXES_DUCK})"


@query(
    "rest_features",
    f"""
SELECT m.record_id, m.mean AS meanAA, m.sd AS sdAA, q."mode" AS modeAA, m.skew AS skewAA, m.kur AS kurAA,
       q.q1 AS q1AA, q.median AS medianAA, q.q3 AS q3AA, q.iqr AS iqrAA, m."range" AS rangeAA,
       o.acf1 AS acfAA, o.zcr AS zcrAA, f.dfa AS dfaAA, f.dfa AS Alpha, tt.turningTime, ls.F0 AS Postpeak, ls.P0 AS Postpower
FROM ({sql_moments(AA_DUCK, 'record_id')}) m
JOIN ({sql_quantiles(AA_DUCK, 'record_id')}) q USING (record_id)
JOIN ({sql_order_stats(AA_DUCK, 'record_id', WALK_ORDER_SQL)}) o USING (record_id)
LEFT JOIN ({sql_dfa(AA_DUCK, 'record_id', WALK_ORDER_SQL)}) f USING (record_id)
JOIN (SELECT record_id, {rsql('arg_max(t, (v, -t)) - min(t)', 'turningTime')} FROM ({AA_DUCK}) GROUP BY record_id) tt USING (record_id)
JOIN ({sql_lomb(AA_DUCK, 'record_id', *LS_GRID)}) ls USING (record_id)
""",
)
def rest_features(spark, d):
    w = walk(spark, d).withColumn("v", SR.magnitude(["X", "Y", "Z"]))
    out = by_length(w.select("record_id", *WALK_ORDER, "t", "v"), ["record_id"], _rest_features)
    return rounded(out, ["record_id"])


def _rest_features(aa: DataFrame, bounded: bool) -> DataFrame:
    k = ["record_id"]
    # written once; every statistic reads it
    aa = bucketed(aa, k, "series") if bounded else spread(aa, [*k, *WALK_ORDER])
    st = FT.series_stats(aa, k, WALK_ORDER, bounded=bounded)
    f = dfa(aa, k, WALK_ORDER, bounded=bounded)
    tt = aa.groupBy("record_id").agg(
        (F.max_by("t", F.struct(F.col("v"), -F.col("t"))) - F.min("t")).alias("turningTime"))
    ls = lomb_scargle_peak(aa, k, "t", "v", *LS_GRID, bounded=bounded)
    return (
        st.join(f, k, "left").join(tt, k).join(ls, k)
        .select(
            "record_id", F.col("mean").alias("meanAA"), F.col("sd").alias("sdAA"), F.col("mode").alias("modeAA"),
            F.col("skew").alias("skewAA"), F.col("kur").alias("kurAA"), F.col("q1").alias("q1AA"),
            F.col("median").alias("medianAA"), F.col("q3").alias("q3AA"), F.col("iqr").alias("iqrAA"),
            F.col("range").alias("rangeAA"), F.col("acf1").alias("acfAA"), F.col("zcr").alias("zcrAA"),
            F.col("dfa").alias("dfaAA"), F.col("dfa").alias("Alpha"), "turningTime",
            F.col("F0").alias("Postpeak"), F.col("P0").alias("Postpower"),
        )
    )


def _vol(cols_sql: str) -> str:
    return " * ".join(f"(max({c}) - min({c}))" for c in cols_sql.split(","))


@query(
    "rest_displacement",
    f"""
WITH v AS (SELECT *, sum(X) OVER r AS vx, sum(Y) OVER r AS vy, sum(Z) OVER r AS vz FROM ({WALK_DUCK})
           WINDOW r AS (PARTITION BY record_id ORDER BY {WALK_ORDER_SQL} ROWS UNBOUNDED PRECEDING)),
d AS (SELECT *, sum(vx) OVER r AS dx, sum(vy) OVER r AS dy, sum(vz) OVER r AS dz FROM v
      WINDOW r AS (PARTITION BY record_id ORDER BY {WALK_ORDER_SQL} ROWS UNBOUNDED PRECEDING)),
dd AS (SELECT *, dx - lag(dx) OVER w AS ddx, dy - lag(dy) OVER w AS ddy, dz - lag(dz) OVER w AS ddz FROM d
       WINDOW w AS (PARTITION BY record_id ORDER BY {WALK_ORDER_SQL}))
SELECT record_id, {rsql('log10(' + _vol('dx,dy,dz') + ')', 'log10_dVol')}, {rsql('log10(' + _vol('ddx,ddy,ddz') + ')', 'log10_ddVol')}
FROM dd GROUP BY record_id
""",
)
def rest_displacement(spark, d):
    """Box volume of the double-integrated X/Y/Z (dVol) and of its first differences (ddVol)."""
    # displacement = double running sum / fs^2; its first difference is the
    # velocity / fs (NULL at the first sample), so one segmented pass serves both
    axes = ("X", "Y", "Z")
    w = segmented(walk(spark, d), ["record_id"], WALK_ORDER, position="pos",
                  running={a: f"{a}_v" for a in axes}, running2={a: f"{a}_d" for a in axes})
    for a in axes:
        w = w.withColumn(f"{a}_dd", F.when(F.col("pos") > 0, F.col(f"{a}_v")))

    def vol(suffix):
        out = None
        for a in ("X", "Y", "Z"):
            r = F.max(f"{a}_{suffix}") - F.min(f"{a}_{suffix}")
            out = r if out is None else out * r
        return out

    out = w.groupBy("record_id").agg(vol("d").alias("dVol"), vol("dd").alias("ddVol"))
    # volumes span many orders of magnitude: compare them on a log scale
    return rounded(out.select("record_id", F.log10("dVol").alias("log10_dVol"), F.log10("ddVol").alias("log10_ddVol")),
                   ["record_id"])


# --------------------------------------------------------------------------
# tremor, record and individual roll-ups, feature naming
# --------------------------------------------------------------------------

@query(
    "tremor_time",
    f"""
SELECT m.vec_id, m.window_id, m.axis, m.mean, q.median AS md, m."min" AS mn, m."max" AS mx, m.sd,
       m.skew AS skewness, m.kur AS kurtosis, q.q1 AS Q25, q.q3 AS Q75, q.iqr AS IQR, m."range", m.rmsmag, m.energy,
       q."mode"
FROM ({sql_moments(TREMOR_LONG_DUCK, T_KEYS_SQL)}) m
JOIN ({sql_quantiles(TREMOR_LONG_DUCK, T_KEYS_SQL)}) q USING ({T_KEYS_SQL})
""",
)
def tremor_time(spark, d):
    out = FT.series_stats(tremor_long(spark, d), T_KEYS, groups=("moments", "quantiles"), bounded=True).select(
        *T_KEYS, "mean", F.col("median").alias("md"), F.col("min").alias("mn"), F.col("max").alias("mx"), "sd",
        F.col("skew").alias("skewness"), F.col("kur").alias("kurtosis"), F.col("q1").alias("Q25"),
        F.col("q3").alias("Q75"), F.col("iqr").alias("IQR"), "range", "rmsmag", "energy", "mode",
    )
    return rounded(out, T_KEYS)


@query(
    "tremor_mobility",
    f"SELECT vec_id, window_id, axis, tkeo AS mtkeo, mobility, complexity FROM ({sql_order_stats(TREMOR_LONG_DUCK, T_KEYS_SQL, 'i', FS)})",
)
def tremor_mobility(spark, d):
    o = FT.order_stats(tremor_long(spark, d), T_KEYS, ["i"], fs=FS, bounded=True)
    return rounded(o.select(*T_KEYS, F.col("tkeo").alias("mtkeo"), "mobility", "complexity"), T_KEYS)


@query(
    "tremor_roughness",
    f"SELECT vec_id, window_id, axis, rough, rugo, dfa FROM ({sql_order_stats(TREMOR_LONG_DUCK, T_KEYS_SQL, 'i', FS)}) "
    f"LEFT JOIN ({sql_dfa(TREMOR_LONG_DUCK, T_KEYS_SQL, 'i')}) USING ({T_KEYS_SQL})",
)
def tremor_roughness(spark, d):
    long = tremor_long(spark, d)
    o = FT.order_stats(long, T_KEYS, ["i"], fs=FS, bounded=True).select(*T_KEYS, "rough", "rugo")
    f = dfa(long, T_KEYS, ["i"], bounded=True)
    return rounded(o.join(f, T_KEYS, "left"), T_KEYS)


BANDS = 5
BAND_W = 10.0


@query(
    "tremor_energy_bands",
    f"SELECT vec_id, window_id, axis, "
    + ", ".join(rsql(f"sum(power) FILTER (WHERE floor(freq / {BAND_W}) = {b})", f"EnergyBand{b}", 4) for b in range(BANDS))
    + ", " + rsql(f"sum(power) FILTER (WHERE freq >= {BAND_W * BANDS})", "EnergyBandAbove", 4)
    + f" FROM ({SPEC_DUCK}) GROUP BY vec_id, window_id, axis",
)
def tremor_energy_bands(spark, d):
    return rounded(SP.band_energies(tremor_spectrum(spark, d), T_KEYS, BAND_W, BANDS), T_KEYS, 4)


@query(
    "tremor_spectral",
    f"""
SELECT vec_id, window_id, axis, {rsql('sum(freq * power) / sum(power)', 'cent')}, {rsql('avg(power)', 'mn', 4)},
       {rsql('arg_max(freq, (power, -bin))', '"mod"')}, {rsql('stddev_samp(power) / sqrt(count(*))', 'sem', 4)},
       {rsql('exp(avg(ln(power)) FILTER (WHERE power > 0)) / avg(power) FILTER (WHERE power > 0)', 'sfm')},
       {rsql('ln(sum(power)) - sum(power * ln(power)) FILTER (WHERE power > 0) / sum(power)', 'sh')}
FROM ({SPEC_DUCK}) WHERE bin > 0 GROUP BY vec_id, window_id, axis
""",
)
def tremor_spectral(spark, d):
    s = SP.spectral_stats(tremor_spectrum(spark, d), T_KEYS)
    s = s.withColumns({c: present(F.col(c), 4) for c in ("mn", "sem")})
    return rounded(s, [*T_KEYS, "mn", "sem"])


ENT_DUCK = f"""
WITH e AS ({EWT_DUCK}),
p AS (SELECT *, energy / sum(energy) OVER (PARTITION BY vec_id, window_id, axis) AS q,
             lead(energy) OVER wb AS e1, lead(energy, 2) OVER wb AS e2
      FROM e WINDOW wb AS (PARTITION BY vec_id, window_id, axis ORDER BY band)),
pat AS (SELECT vec_id, window_id, axis,
               concat(CAST((e1 < energy)::INT + (e2 < energy)::INT AS VARCHAR),
                      CAST((energy <= e1)::INT + (e2 < e1)::INT AS VARCHAR),
                      CAST((energy <= e2)::INT + (e1 <= e2)::INT AS VARCHAR)) AS pattern
        FROM p WHERE e2 IS NOT NULL),
pc AS (SELECT vec_id, window_id, axis, pattern, count(*) AS cnt FROM pat GROUP BY ALL),
perm AS (SELECT vec_id, window_id, axis, -sum(pp * ln(pp)) / ln(6.0) AS permEnt FROM (
           SELECT *, cnt / sum(cnt) OVER (PARTITION BY vec_id, window_id, axis) AS pp FROM pc) GROUP BY ALL),
base AS (SELECT vec_id, window_id, axis, -sum(CASE WHEN q > 0 THEN q * ln(q) END) AS shannonEnt,
                1.0 - sum(q * q) AS simpsonEnt, ln(sum(pow(q, 2.0))) / (1.0 - 2.0) AS renyiEnt,
                (1.0 - sum(pow(q, 2.0))) / (2.0 - 1.0) AS tsallisEnt
         FROM p GROUP BY vec_id, window_id, axis)
SELECT base.vec_id, base.window_id, base.axis, {rsql('shannonEnt', 'shannonEnt')}, {rsql('simpsonEnt', 'simpsonEnt')},
       {rsql('renyiEnt', 'renyiEnt')}, {rsql('tsallisEnt', 'tsallisEnt')}, {rsql('permEnt', 'permEnt')}
FROM base LEFT JOIN perm USING (vec_id, window_id, axis)
"""


@query("tremor_entropy", ENT_DUCK)
def tremor_entropy(spark, d):
    """EWT energy entropies per tremor window (Shannon, Simpson, Renyi, Tsallis, permutation)."""
    e = ewt_energy_raw(spark, d)
    return rounded(SP.energy_entropies(e, T_KEYS), T_KEYS)


ROLL_FEATS = ["mean", "sd", "energy"]


def _window_features(spark, d) -> DataFrame:
    """Long (vec_id, label, window_id, axis, feature, value) of tremor time features."""
    long = tremor_long(spark, d)
    labels = tremor(spark, d).select("vec_id", "label").distinct()
    m = FT.moment_stats(long, T_KEYS).select(*T_KEYS, *ROLL_FEATS)
    return unpivot(m.join(labels, "vec_id"), ["vec_id", "label", *T_KEYS[1:]], ROLL_FEATS, "feature", "value")


WF_DUCK = f"""
SELECT vec_id, label, window_id, axis, feature, value FROM (
  SELECT vec_id, window_id, axis, any_value(label) AS label, avg(v) AS mean, stddev_samp(v) AS sd, sum(v * v) AS energy
  FROM ({TREMOR_LONG_DUCK}) GROUP BY vec_id, window_id, axis)
UNPIVOT (value FOR feature IN (mean, sd, energy))
"""


def record_rollup_df(spark, d) -> DataFrame:
    from curatio.operators.quantiles import group_quantiles

    # a recording may have very many windows: skew-safe histogram quantiles across them
    wf = _window_features(spark, d)
    q = group_quantiles(wf, ["vec_id", "label", "axis", "feature"], "value", [0.25, 0.5, 0.75], ["q1", "md", "q3"],
                        mode=None)
    return q.select("vec_id", "label", "axis", "feature", "md", (F.col("q3") - F.col("q1")).alias("iqr"))


RR_DUCK = f"""
SELECT vec_id, label, axis, feature, {sql_q('l', 0.5)} AS md, {sql_q('l', 0.75)} - {sql_q('l', 0.25)} AS iqr
FROM (SELECT vec_id, label, axis, feature, list(value ORDER BY value) AS l FROM ({WF_DUCK}) GROUP BY ALL)
"""


@query("record_rollup", f"SELECT vec_id, axis, feature, {rsql('md', 'md')}, {rsql('iqr', 'iqr')} FROM ({RR_DUCK})")
def record_rollup(spark, d):
    """Per record: median and IQR of each window feature across its windows."""
    return rounded(record_rollup_df(spark, d).drop("label"), ["vec_id", "axis", "feature"])


@query(
    "individual_rollup",
    f"""
SELECT label, axis, feature, stat, {rsql(sql_q('l', 0.5), '"MD"')},
       {rsql(sql_q('l', 0.75) + ' - ' + sql_q('l', 0.25), '"IQR"')}
FROM (SELECT label, axis, feature, stat, list(value ORDER BY value) AS l
      FROM ({RR_DUCK}) UNPIVOT (value FOR stat IN (md, iqr)) GROUP BY ALL)
""",
)
def individual_rollup(spark, d):
    """Per individual (label): median and IQR of each record-level feature across records."""
    from curatio.operators.quantiles import group_quantiles

    rr = unpivot(record_rollup_df(spark, d), ["vec_id", "label", "axis", "feature"], ["md", "iqr"], "stat", "value")
    # an individual may own a large share of all records: skew-safe histogram quantiles
    q = group_quantiles(rr, ["label", "axis", "feature", "stat"], "value", [0.25, 0.5, 0.75], ["q1", "MD", "q3"],
                        mode=None)
    out = q.select("label", "axis", "feature", "stat", "MD", (F.col("q3") - F.col("q1")).alias("IQR"))
    return rounded(out, ["label", "axis", "feature", "stat"])


PIVOT_NAMES = [f"{f}.tm.{s}_{a}_accelerometer" for f in ROLL_FEATS for s in ("md", "iqr") for a in ("ua", "uv", "ud", "uj")]


@query(
    "feature_pivot",
    "SELECT vec_id, "
    + ", ".join(
        rsql(f"max(value) FILTER (WHERE name = '{n}')", f'"{n}"') for n in PIVOT_NAMES
    )
    + f""" FROM (SELECT vec_id, concat_ws('_', concat(feature, '.tm.', stat), axis, 'accelerometer') AS name, value
       FROM ({RR_DUCK}) UNPIVOT (value FOR stat IN (md, iqr))) GROUP BY vec_id""",
)
def feature_pivot(spark, d):
    """Wide table, one column per ``<feature>.<domain>.<stat>_<axis>_<sensor>``."""
    rr = unpivot(record_rollup_df(spark, d), ["vec_id", "axis", "feature"], ["md", "iqr"], "stat", "value")
    named = rr.withColumn("name", F.concat_ws("_", F.concat("feature", F.lit(".tm."), "stat"), "axis",
                                              F.lit("accelerometer")))
    wide = named.groupBy("vec_id").pivot("name", PIVOT_NAMES).agg(F.max("value"))
    return rounded(wide, ["vec_id"])


def _by_sensor(spark, d, features) -> DataFrame:
    """``features`` of the accelerometer waveforms and of the gyroscope's, one scan each."""
    parts = []
    for sensor, own in (("accelerometer", True), ("gyroscope", False)):
        mine = F.coalesce(F.col("label") < 5, F.lit(False)) == F.lit(own)
        w = table(spark, d, "embeddings").where(mine).select("vec_id", F.posexplode("embedding").alias("i", "v"))
        parts.append(features(w, "vec_id", "i", "v", sensor=sensor, fs=FS, window=WIN, step=STEP, band_width=BAND_W, n_bands=BANDS))
    return parts[0].unionByName(parts[1])


@query("tremor_feature_table")
def tremor_feature_table(spark, d):
    """The full tremor table ``<feature>.<domain>.<IMF>.<stat>_<axis>_<sensor>`` per vector, both sensors, every
    mode: derived axes, 32-sample windows, ACF axis, EMD, time/frequency statistics, EWT entropies, median/IQR
    across windows.  EMD has no SQL form; the names without a mode are compared in ``tremor_raw_table``."""
    from curatio.sensors.tremor import tremor_features

    return _by_sensor(spark, d, tremor_features)


# Axis names of the gyroscope for those of the accelerometer's derivation.
RAW_AXES_DUCK = f"""
SELECT vec_id, window_id, i, v, CASE WHEN label < 5 THEN axis ELSE CASE axis WHEN 'ua' THEN 'uav' WHEN 'uv' THEN 'uad' ELSE 'uaa' END END AS axis,
       CASE WHEN label < 5 THEN 'accelerometer' ELSE 'gyroscope' END AS sensor
FROM ({TREMOR_LONG_DUCK}) WHERE label < 5 OR axis <> 'ud'
"""
RAW_LONG_DUCK = f"""
WITH r AS ({RAW_AXES_DUCK}),
c AS (SELECT vec_id, window_id, sensor, v - avg(v) OVER w AS c, count(*) OVER w AS n,
             row_number() OVER (PARTITION BY vec_id, window_id ORDER BY i) - 1 AS j
      FROM r WHERE axis IN ('ua', 'uav') WINDOW w AS (PARTITION BY vec_id, window_id)),
f AS (SELECT a.vec_id, a.window_id, a.sensor, b.j - a.j AS lag, sum(a.c * b.c) AS s
      FROM c a JOIN c b ON a.vec_id = b.vec_id AND a.window_id = b.window_id AND a.j <= b.j GROUP BY ALL)
SELECT vec_id, window_id, axis, sensor, CAST(i AS BIGINT) AS i, v FROM r
UNION ALL
SELECT vec_id, window_id, CASE sensor WHEN 'accelerometer' THEN 'uaacf' ELSE 'uavacf' END, sensor, lag,
       s / first_value(s) OVER (PARTITION BY vec_id, window_id ORDER BY lag) FROM f
"""
RAW_KEYS = "vec_id, window_id, axis, sensor"
RAW_SPEC_DUCK = f"""
SELECT {RAW_KEYS}, g.k AS bin, g.k * {FS!r} / n AS freq,
       (pow(sum(c * cos(2 * pi() * g.k * j / n)), 2) + pow(sum(c * sin(2 * pi() * g.k * j / n)), 2)) / n AS power
FROM (SELECT {RAW_KEYS}, v - avg(v) OVER w AS c, row_number() OVER (PARTITION BY {RAW_KEYS} ORDER BY i) - 1 AS j, count(*) OVER w AS n
      FROM raw_long WINDOW w AS (PARTITION BY {RAW_KEYS})) x, range(0, {WIN // 2 + 1}) g(k)
WHERE g.k <= n // 2 GROUP BY {RAW_KEYS}, g.k, n
"""
RAW_TM = {"mean": "mean", "sd": "sd", "skewness": "skew", "kurtosis": "kur", "mn": '"min"', "mx": '"max"', "range": '"range"',
          "rmsmag": "rmsmag", "energy": "energy", "md": "median", "Q25": "q1", "Q75": "q3", "IQR": "iqr", "mtkeo": "tkeo",
          "mobility": "mobility", "complexity": "complexity", "rough": "rough", "rugo": "rugo"}
RAW_FR = {"cent": "sum(freq * power) / sum(power)", "mn": "avg(power)", "mod": "arg_max(freq, (power, -bin))",
          "sem": "stddev_samp(power) / sqrt(count(*))"}
# Presented to so many decimals of its size: the features span twelve orders of magnitude.
RAW_DIGITS = 7


def _significant(x):
    """A column or SQL text rounded to ``RAW_DIGITS`` decimals of its order of magnitude (0 stays 0)."""
    if isinstance(x, str):
        scale = f"pow(10.0, {RAW_DIGITS} - ceil(log10(abs({x}))))"
        return f"CASE WHEN abs({x}) > 1e-12 THEN floor({x} * {scale} + 0.4987) / {scale} WHEN {x} IS NOT NULL THEN 0.0 END"
    scale = F.pow(F.lit(10.0), F.lit(RAW_DIGITS) - F.ceil(F.log10(F.abs(x))))
    return F.when(F.abs(x) > 1e-12, F.floor(x * scale + F.lit(0.4987)) / scale).when(x.isNotNull(), F.lit(0.0))


@query(
    "tremor_raw_table",
    f"""
WITH raw_long AS MATERIALIZED (SELECT * FROM ({RAW_LONG_DUCK}) WHERE v IS NOT NULL),
tm AS (SELECT * FROM ({sql_moments('raw_long', RAW_KEYS, None)}) JOIN ({sql_quantiles('raw_long', RAW_KEYS, None)}) USING ({RAW_KEYS})
       JOIN ({sql_order_stats('raw_long', RAW_KEYS, 'i', FS, None)}) USING ({RAW_KEYS})),
wf AS ("""
    + " UNION ALL ".join(f"SELECT {RAW_KEYS}, 'tm' AS domain, '{n}' AS feature, CAST({e} AS DOUBLE) AS value FROM tm" for n, e in RAW_TM.items())
    + "".join(f" UNION ALL SELECT {RAW_KEYS}, 'fr', '{n}', {e} FROM ({RAW_SPEC_DUCK}) WHERE bin > 0 GROUP BY {RAW_KEYS}" for n, e in RAW_FR.items())
    + f"""),
l AS (SELECT vec_id, axis, sensor, domain, feature, list(value ORDER BY value) AS l FROM wf WHERE value IS NOT NULL GROUP BY ALL),
q AS (SELECT *, {sql_q('l', 0.5)} AS md, {sql_q('l', 0.75)} - {sql_q('l', 0.25)} AS iqr FROM l)
SELECT vec_id, concat_ws('_', concat_ws('.', feature, domain, stat), axis, sensor) AS name, {_significant('value')} AS value
FROM q UNPIVOT (value FOR stat IN (md, iqr))""",
)
def tremor_raw_table(spark, d):
    """The names of the tremor table that have no mode: both sensors, every axis with its ACF, time and frequency domain."""
    from curatio.sensors.tremor import tremor_features

    named = [f"{f}.tm" for f in RAW_TM] + [f"{f}.fr" for f in RAW_FR]

    def raw(*args, **kw):
        return tremor_features(*args, **kw, n_imf=0)

    t = _by_sensor(spark, d, raw)
    keep = F.regexp_extract("name", r"^(.*)\.(md|iqr)_[a-z]+_[a-z]+$", 1).isin(named)
    return t.where(keep).select("vec_id", "name", _significant(F.col("value")).alias("value"))


# --------------------------------------------------------------------------
# the released wide tables
# --------------------------------------------------------------------------


def _wide(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*keys, *[_significant(F.col(f"`{c}`")).alias(c) for c in df.columns if c not in keys])


def _wide_sql(src: str, keys: list[str], names: list[str]) -> str:
    quoted = [f'"{n}"' for n in names]
    return f"SELECT {', '.join(keys)}, {', '.join(f'{_significant(n)} AS {n}' for n in quoted)} FROM ({src})"


# Dictionary names of the statistics that the oracles' builders call otherwise.
TAP_SQL = {"skew": "skew", "kur": "kur", "ar1": "acf1", "ar2": "acf2", "min": '"min"', "max": '"max"', "range": '"range"'}
TAP_TABLE_DUCK = f"""
WITH s AS (SELECT * FROM ({sql_moments(TAP_SERIES_DUCK, 'record_id, series', None)}) JOIN ({sql_quantiles(TAP_SERIES_DUCK, 'record_id, series', None)})
             USING (record_id, series) JOIN ({sql_order_stats(TAP_SERIES_DUCK, 'record_id, series', 'ts, event_id', digits=None)}) USING (record_id, series)),
p AS (SELECT record_id, v, row_number() OVER (PARTITION BY record_id ORDER BY ts, event_id) AS i,
             count(*) OVER (PARTITION BY record_id) AS n FROM ({TAPINTER_DUCK})),
f AS (SELECT record_id, {", ".join(f"avg(v) FILTER (WHERE i <= ceil(n * {x})) - avg(v) FILTER (WHERE i > n - ceil(n * {x})) AS fatigue{t}TapInter"
                                   for x, t in [(0.1, 10), (0.25, 25), (0.5, 50)])} FROM p GROUP BY record_id),
t AS (SELECT record_id, count(*) AS numberTaps, avg(CASE WHEN button = 'none' THEN 1.0 ELSE 0.0 END) AS buttonNoneFreq,
             CASE WHEN stddev_pop(x) * stddev_pop(y) <> 0 THEN covar_pop(x, y) / (stddev_pop(x) * stddev_pop(y)) END AS corXY
      FROM ({TAPS_DUCK}) GROUP BY record_id),
w AS (SELECT record_id, """ + ", ".join(
    f"max({TAP_SQL.get(stat, stat)}) FILTER (WHERE series = '{series}') AS \"{stat}{series}\""
    for series in AC.TAP_SERIES for stat in AC.TAP_STATS + (["tkeo", "ar1", "ar2"] if series == "TapInter" else [])
) + """ FROM s GROUP BY record_id)
SELECT * FROM t LEFT JOIN w USING (record_id) LEFT JOIN f USING (record_id)"""


@query("tapping_table", _wide_sql(TAP_TABLE_DUCK, ["record_id"], AC.tapping_names()))
def tapping_table(spark, d):
    """The 42 tapping features of every record."""
    return _wide(AC.tapping_features(taps(spark, d), "record_id", TAP_ORDER, "t"), ["record_id"])


WALK_SQL = {"acf": "acf1", "mode": '"mode"', "range": '"range"'}
WALK_LONG_VALUES = WALK_LONG_DUCK + " WHERE v IS NOT NULL"
WALK_TABLE_DUCK = f"""
WITH s AS (SELECT * FROM ({sql_moments(WALK_LONG_VALUES, W_KEYS_SQL, None)}) JOIN ({sql_quantiles(WALK_LONG_VALUES, W_KEYS_SQL, None)}) USING ({W_KEYS_SQL})
             JOIN ({sql_order_stats(WALK_LONG_VALUES, W_KEYS_SQL, WALK_ORDER_SQL, digits=None)}) USING ({W_KEYS_SQL})
             LEFT JOIN ({sql_dfa(WALK_LONG_VALUES, W_KEYS_SQL, WALK_ORDER_SQL, digits=None)}) USING ({W_KEYS_SQL})
             JOIN ({sql_lomb(WALK_LONG_VALUES, W_KEYS_SQL, *LS_GRID, digits=None)}) USING ({W_KEYS_SQL})),
c AS (SELECT record_id, """ + ", ".join(
    f"CASE WHEN stddev_pop({a}) * stddev_pop({b}) <> 0 THEN covar_pop({a}, {b}) / (stddev_pop({a}) * stddev_pop({b})) END AS cor{a}{b}"
    for a, b in [("X", "Y"), ("X", "Z"), ("Y", "Z")]
) + f""" FROM ({WALK_DUCK}) GROUP BY record_id),
w AS (SELECT record_id, """ + ", ".join(
    f"max({WALK_SQL.get(stat, stat)}) FILTER (WHERE axis = '{axis}') AS \"{stat}{axis}\"" for stat in AC.WALK_STATS for axis in AC.WALK_AXES
) + """ FROM s GROUP BY record_id)
SELECT * FROM w JOIN c USING (record_id)"""


@query("walking_table", _wide_sql(WALK_TABLE_DUCK, ["record_id"], AC.walk_names()))
def walking_table(spark, d):
    """The 17 walking features on five axes and the three correlations of every record."""
    f_min, f_max, n_freq = LS_GRID
    return _wide(AC.walk_features(walk(spark, d), "record_id", WALK_ORDER, "t", f_min=f_min, f_max=f_max, n_freq=n_freq), ["record_id"])


REST_TABLE_DUCK = f"""
WITH v AS (SELECT *, sum(X) OVER r AS vx, sum(Y) OVER r AS vy, sum(Z) OVER r AS vz, row_number() OVER r AS k FROM ({WALK_DUCK})
           WINDOW r AS (PARTITION BY record_id ORDER BY {WALK_ORDER_SQL} ROWS UNBOUNDED PRECEDING)),
d AS (SELECT *, sum(vx) OVER r AS dx, sum(vy) OVER r AS dy, sum(vz) OVER r AS dz FROM v
      WINDOW r AS (PARTITION BY record_id ORDER BY {WALK_ORDER_SQL} ROWS UNBOUNDED PRECEDING)),
b AS (SELECT record_id, {_vol('dx,dy,dz')} AS dVol, (max(vx) FILTER (WHERE k > 1) - min(vx) FILTER (WHERE k > 1))
        * (max(vy) FILTER (WHERE k > 1) - min(vy) FILTER (WHERE k > 1)) * (max(vz) FILTER (WHERE k > 1) - min(vz) FILTER (WHERE k > 1)) AS ddVol
      FROM d GROUP BY record_id)
SELECT record_id, m.mean AS meanAA, m.sd AS sdAA, q."mode" AS modeAA, m.skew AS skewAA, m.kur AS kurAA, q.q1 AS q1AA, q.median AS medianAA,
       q.q3 AS q3AA, q.iqr AS iqrAA, m."range" AS rangeAA, o.acf1 AS acfAA, o.zcr AS zcrAA, f.dfa AS dfaAA, f.dfa AS Alpha,
       tt.turningTime, ls.F0 AS Postpeak, ls.P0 AS Postpower, b.dVol, b.ddVol
FROM ({sql_moments(AA_DUCK, 'record_id', None)}) m JOIN ({sql_quantiles(AA_DUCK, 'record_id', None)}) q USING (record_id)
JOIN ({sql_order_stats(AA_DUCK, 'record_id', WALK_ORDER_SQL, digits=None)}) o USING (record_id)
LEFT JOIN ({sql_dfa(AA_DUCK, 'record_id', WALK_ORDER_SQL, digits=None)}) f USING (record_id)
JOIN (SELECT record_id, arg_max(t, (v, -t)) - min(t) AS turningTime FROM ({AA_DUCK}) GROUP BY record_id) tt USING (record_id)
JOIN ({sql_lomb(AA_DUCK, 'record_id', *LS_GRID, digits=None)}) ls USING (record_id) JOIN b USING (record_id)"""


@query("rest_table", _wide_sql(REST_TABLE_DUCK, ["record_id"], AC.REST_NAMES))
def rest_table(spark, d):
    """The 19 balance features of every record."""
    f_min, f_max, n_freq = LS_GRID
    return _wide(AC.rest_features(walk(spark, d), "record_id", WALK_ORDER, "t", fs=1.0, f_min=f_min, f_max=f_max, n_freq=n_freq), ["record_id"])


@query(
    "sampling_rate",
    f"SELECT record_id, {_significant('fs')} AS fs FROM (SELECT record_id, CASE WHEN {sql_q('l', 0.5)} <> 0 THEN 1 / {sql_q('l', 0.5)} END AS fs "
    f"FROM (SELECT record_id, list(v ORDER BY v) AS l FROM ({TAPINTER_DUCK}) GROUP BY record_id))",
)
def sampling_rate(spark, d):
    """Samples a second of every record, from the median time step."""
    return _wide(SR.sampling_rate(taps(spark, d).select("record_id", *TAP_ORDER, "t"), ["record_id"], TAP_ORDER, "t"), ["record_id"])


@query(
    "time_windows",
    "SELECT user_id, window_id, count(*) AS n, sum(value) AS total FROM (SELECT user_id, value, "
    "CAST(unnest([floor(epoch(ts) / 1800) * 1800 - 1800, floor(epoch(ts) / 1800) * 1800]) AS BIGINT) AS window_id FROM events) GROUP BY ALL",
)
def time_windows(spark, d):
    """Sliding windows of an hour, half an hour apart, by the events' time."""
    from curatio.operators.windows import time_windows as cut

    w = cut(table(spark, d, "events").select("user_id", "ts", "value"), "ts", "1 hour", "30 minutes")
    return w.groupBy("user_id", "window_id").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
