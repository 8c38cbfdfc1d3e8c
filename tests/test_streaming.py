"""Incremental curate on a file stream: new files are picked up, restarts do not duplicate rows."""

import datetime as dt
import os
import tempfile

import pytest

from curatio.plans.curate import Source, TableSpec
from curatio.streaming.curate_stream import curate_stream_frame, start_curate_stream

SCHEMA = ("recordId string, healthCode string, createdOn timestamp, userSharingScope string, "
          "dataGroups string, rawData string")
SPEC = TableSpec(name="Stream", sources=[Source("s")], date_col="createdOn")


def _rows(prefix, n):
    day = dt.datetime(2018, 1, 1)
    return [(f"{prefix}{i}", "bad" if i == 0 else f"p{i}", day, "ALL_QUALIFIED_RESEARCHERS", "g", "raw")
            for i in range(n)]


def test_stream_picks_up_new_files_and_restarts_exactly_once(spark):
    root = tempfile.mkdtemp(prefix="curatio-stream-")
    src, sink, ckpt = (os.path.join(root, n) for n in ("source", "sink", "checkpoint"))
    ex = spark.createDataFrame([("bad",)], "healthCode string")
    wd = spark.createDataFrame([], "healthCode string")
    spark.createDataFrame(_rows("a", 5), SCHEMA).write.mode("append").parquet(src)
    start_curate_stream(spark, src, SCHEMA, SPEC, ex, wd, sink, ckpt).awaitTermination()
    assert spark.read.parquet(sink).count() == 4           # 'bad' excluded
    spark.createDataFrame(_rows("b", 3), SCHEMA).write.mode("append").parquet(src)
    start_curate_stream(spark, src, SCHEMA, SPEC, ex, wd, sink, ckpt).awaitTermination()  # restart
    ids = sorted(r.recordId for r in spark.read.parquet(sink).collect())
    assert ids == ["a1", "a2", "a3", "a4", "b1", "b2"]      # each new row once, nothing re-processed
    assert "rawData" not in spark.read.parquet(sink).columns and "dataGroups" not in spark.read.parquet(sink).columns


def test_stream_refuses_dedup_specs(spark):
    stream = spark.readStream.schema(SCHEMA).parquet(tempfile.mkdtemp())
    spec = TableSpec(name="D", sources=[Source("s")], date_col="createdOn", dedup=True)
    with pytest.raises(ValueError):
        curate_stream_frame(stream, spec, stream, stream)
