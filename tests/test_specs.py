"""Every table spec through the standard pipeline, and one full release with attachments."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import types as T

from curatio.plans.curate import SPECS, STANDARD_DROP, curate
from curatio.plans.release import ReleaseOutputs, release

OK = dt.datetime(2018, 1, 1)
EARLY = dt.datetime(2017, 1, 1)
BASE = ["recordId", "healthCode", "createdOn", "metadata.json.startDate", "userSharingScope", "ROW_ID", "rawData",
        *[c for c in STANDARD_DROP if c != "userSharingScope"]]


def frame_for(spark, spec, source, index):
    cols = list(BASE)
    for extra in [*spec.drop, *spec.json_columns, *spec.not_null, *(spec.keep or [])]:
        if extra not in cols:
            cols.append(extra)
    # the first version carries the old names that the renames align
    for old, new in source.renames.items():
        if new in cols:
            cols.remove(new)
        cols.append(old)
    later = [s for s in spec.sources if s.enabled and s.renames]
    if index > 0 and later:
        for old, new in later[0].renames.items():
            if new not in cols:
                cols.append(new)
    rows = []
    for i, (hc, day, scope) in enumerate([
        ("p1", OK, "ALL_QUALIFIED_RESEARCHERS"), ("p2", EARLY, "ALL_QUALIFIED_RESEARCHERS"),
        ("bad", OK, "ALL_QUALIFIED_RESEARCHERS"), ("p4", OK, "SPONSORS_AND_PARTNERS"), (None, OK, "ALL_QUALIFIED_RESEARCHERS"),
    ]):
        vals = []
        for col in cols:
            if col == "recordId":
                vals.append(f"r{index}{i}")
            elif col == "healthCode":
                vals.append(hc)
            elif col in ("createdOn", "metadata.json.startDate"):
                vals.append(day)
            elif col == "userSharingScope":
                vals.append(scope)
            elif col == "ROW_ID":
                vals.append(i)
            elif col.endswith("choiceAnswers"):
                vals.append('["a","b"]')
            else:
                vals.append("x")
        rows.append(tuple(vals))
    fields = []
    for col in cols:
        t = T.TimestampType() if col in ("createdOn", "metadata.json.startDate") else (
            T.LongType() if col == "ROW_ID" else T.StringType())
        fields.append(T.StructField(col, t))
    return spark.createDataFrame(rows, T.StructType(fields))


@pytest.mark.parametrize("name", sorted(SPECS))
def test_every_spec_curates(spark, name):
    spec = SPECS[name]
    ex = spark.createDataFrame([("bad",)], "healthCode string")
    wd = spark.createDataFrame([("gone",)], "healthCode string")
    frames = {s.table: frame_for(spark, spec, s, i) for i, s in enumerate([s for s in spec.sources if s.enabled])}
    out = curate(spec, frames, ex, wd)
    n_versions = len(frames)
    got = sorted(r["recordId"] for r in out.collect())
    assert len(got) == 2 * n_versions  # p1 and the NULL participant survive per version
    for dropped in (*spec.drop, "rawData", "ROW_ID"):
        if spec.keep is None or dropped not in spec.keep:
            assert dropped not in out.columns


def test_release_symptoms_with_documents_and_lineage(spark):
    spec = SPECS["symptoms"]
    src = frame_for(spark, spec, spec.sources[0], 0)
    ex = spark.createDataFrame([("bad",)], "healthCode string")
    wd = spark.createDataFrame([], "healthCode string")
    root = tempfile.mkdtemp(prefix="curatio-release-")
    outs = ReleaseOutputs(*(os.path.join(root, n) for n in ("table", "payloads", "documents", "provenance")))
    target = T.StructType([T.StructField(n, T.StringType()) for n in ["recordId", "healthCode", "symptomTiming.json.choiceAnswers"]]
                          + [T.StructField("createdOn", T.TimestampType())])
    out = release(spec, {"symptoms": src}, ex, wd, outs, target=target, executed="test")
    rows = out.collect()
    assert len(rows) == 2 and all(len(r["symptomTiming.json.choiceAnswers"]) == 64 for r in rows)
    docs = spark.read.parquet(outs.documents).collect()
    assert [d.document for d in docs] == ['["a","b"]']
    prov = spark.read.parquet(outs.provenance).collect()[0]
    assert prov.target == "Symptoms Survey" and prov.n_rows == 2 and prov.used == ["symptoms"]


def test_release_rehomes_attachments(spark):
    spec = SPECS["tapping"]
    ex = spark.createDataFrame([], "healthCode string")
    wd = spark.createDataFrame([], "healthCode string")
    frames = {s.table: frame_for(spark, spec, s, i) for i, s in enumerate(spec.sources)}
    att = spark.createDataFrame([("x", "payload")], "handle string, content string")
    root = tempfile.mkdtemp(prefix="curatio-release-")
    outs = ReleaseOutputs(*(os.path.join(root, n) for n in ("table", "payloads", "documents", "provenance")))
    out = release(spec, frames, ex, wd, outs, attachments=att,
                  handle_columns=("accelerometer_tapping_left.json.items",))
    handles = {r["accelerometer_tapping_left.json.items"] for r in out.collect()}
    assert len(handles) == 1 and len(next(iter(handles))) == 64
    assert spark.read.parquet(outs.payloads).count() == 1
