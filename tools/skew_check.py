"""Hot-recording experiment: whole-record windows vs the segmented (chunked) series.

AQE partition coalescing is switched off for the experiment (at test size
it would merge every shuffle partition into one and hide the distribution).

A walk series is derived from ``lineitem`` in which one recording holds about
a third of all rows (suppliers 0-32 folded into recording 0).  For each mode
the ordered statistics are computed (noop sink, warm run), and the rows per
task after the series step are counted with ``spark_partition_id``.

    python tools/skew_check.py [sf_dir]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from curatio.operators.segmented import segmented, spread
    from curatio.session import get_spark
    from curatio.sensors import features as FT
    from curatio.sources.testtables import table

    spark = get_spark("local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    # at this size AQE would coalesce all shuffle partitions into one; switch that off so the
    # counts show how the rows are distributed, as they would be at scale
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    li = table(spark, sf, "lineitem")
    series = li.select(
        F.when(F.col("l_suppkey") < 33 * (li.select(F.max("l_suppkey")).first()[0] + 1) // 100, F.lit(0))
        .otherwise(F.col("l_suppkey")).alias("record_id"),
        "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").alias("v"),
        F.col("l_extendedprice").alias("p"),
    )
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"]
    total = series.count()
    hot = series.where("record_id = 0").count()
    lines = ["", f"rows {total}, hot recording {hot} ({hot / total:.0%})", "",
             "| mode | wall s (warm) | max rows per task after the series step | tasks holding the hot recording |",
             "|---|---|---|---|"]
    for label, cut in [("whole-record windows", {"bounded": True}), ("chunks by rows", {"rows": total // 16})]:
        stats = FT.series_stats(series, ["record_id"], order, **cut, groups=("ordered",))
        for _ in range(2):
            t0 = time.perf_counter()
            stats.write.format("noop").mode("overwrite").save()
            wall = time.perf_counter() - t0
        seg = segmented(series, ["record_id"], order, **cut, lags={"v": [1]}).withColumn("pid", F.spark_partition_id())
        # consume the lag so Catalyst keeps the series step (and the partition id is read after it)
        per = seg.groupBy("pid").agg(F.count(F.lit(1)).alias("n"), F.sum("lag1_v").alias("s"),
                                     F.sum(F.when(F.col("record_id") == 0, 1).otherwise(0)).alias("h"))
        r = per.agg(F.max("n").alias("mx"), F.sum(F.when(F.col("h") > 0, 1).otherwise(0)).alias("ht"),
                    F.sum("s").alias("s")).first()
        lines.append(f"| {label} | {wall:.2f} | {r.mx} | {r.ht} |")
    # quantiles: percentile buffers vs the value histogram
    from curatio.operators.quantiles import group_quantiles

    # prices: nearly every value distinct, so a percentile buffer holds the whole recording
    lines += ["", "| quantiles of the prices | wall s (warm) | largest unit of work in one task |", "|---|---|---|"]
    pct = series.groupBy("record_id").agg(F.percentile("p", [0.25, 0.5, 0.75]).alias("q"))
    hist = group_quantiles(series, ["record_id"], "p", [0.25, 0.5, 0.75], ["q1", "md", "q3"], mode=None)
    for label, df in [("percentile (one buffer per recording)", pct), ("value histogram, cells by rows", hist)]:
        for _ in range(2):
            t0 = time.perf_counter()
            df.write.format("noop").mode("overwrite").save()
            wall = time.perf_counter() - t0
        if df is pct:
            n = series.where("record_id = 0").select("p").distinct().count()
            unit = f"{n} distinct values of the hot recording merged by one task"
        else:
            h = series.groupBy("record_id", "p").count()
            r = spread(h, ["record_id", "p"], h.count() // 16).groupBy("__chunk").count().agg(F.max("count").alias("mx")).first()
            unit = f"{r.mx} histogram rows (all recordings) in the largest cell"
        lines.append(f"| {label} | {wall:.2f} | {unit} |")
    print("\n".join(lines))
    spark.stop()


if __name__ == "__main__":
    main()
