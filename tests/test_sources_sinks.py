"""Sources and sinks: catalog scans, binaryFile payloads, typed publish, provenance."""

import os
import tempfile

import pytest
from pyspark.sql import types as T

from curatio.plans.curate import SPECS
from curatio.plans.publish import append_provenance, provenance_with_count, publish_typed
from curatio.sources.catalog import Catalog, attachment_files, inline_table


def test_catalog_scan_skips_columns_and_pushes_participant_filter(spark):
    root = tempfile.mkdtemp(prefix="curatio-cat-")
    df = spark.createDataFrame([(1, 1, "p1", "raw", 3.0), (2, 1, "p2", "raw", 4.0)],
                               "ROW_ID bigint, ROW_VERSION bigint, healthCode string, rawData string, v double")
    df.write.parquet(os.path.join(root, "survey.parquet"))
    cat = Catalog(spark, root=root)
    scan = cat.scan("survey")
    assert scan.columns == ["healthCode", "v"]
    one = cat.scan_participant("survey", "p2")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(healthCode), EqualTo(healthCode,p2)]" in plan
    assert "rawData" not in plan.split("ReadSchema")[1].split("\n")[0]
    assert [r.v for r in one.collect()] == [4.0]


def test_binary_file_payloads_keyed_by_file_name(spark):
    root = tempfile.mkdtemp(prefix="curatio-att-")
    for h, text in [("h1", "alpha"), ("h2", "beta")]:
        with open(os.path.join(root, f"{h}.json"), "w") as f:
            f.write(text)
    got = {r.handle: bytes(r.content).decode() for r in attachment_files(spark, root, "*.json").collect()}
    assert got == {"h1": "alpha", "h2": "beta"}


def test_publish_typed_strict_raises_and_lenient_writes_nulls(spark):
    df = spark.createDataFrame([("1", "x"), ("2", "3")], "a string, b string")
    target = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())])
    with pytest.raises(ValueError):
        publish_typed(df, target, os.path.join(tempfile.mkdtemp(), "t"))
    path = os.path.join(tempfile.mkdtemp(), "t")
    publish_typed(df, target, path, strict=False)
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, None), (2, 3)]


def test_tremor_schema_keeps_a_column_the_data_drops(spark):
    spec = SPECS["tremor"]
    assert "metadata.json.dataGroups" in spec.drop
    assert "metadata.json.dataGroups" not in spec.schema_drop


def test_provenance_rows_append(spark):
    path = os.path.join(tempfile.mkdtemp(), "prov")
    data = inline_table(spark, [(1,), (2,)], "x int")
    for _ in range(2):
        append_provenance(provenance_with_count(data, "T", ["a", "b"], "run"), path)
    rows = spark.read.parquet(path).collect()
    assert len(rows) == 2 and all(r.n_rows == 2 and r.used == ["a", "b"] for r in rows)


def files(spark, rows):
    return spark.createDataFrame(rows, "handle string, content string")


def test_payload_store_adds_only_what_it_lacks(spark):
    from curatio.plans.attachments import store_payloads

    store = os.path.join(tempfile.mkdtemp(), "store")
    used = spark.createDataFrame([("a",), ("b",), ("c",), ("gone",), ("none",)], "handle string")
    # a and b are copies, a stands twice, none has no payload, d is not used
    rows = [("a", "one"), ("a", "one"), ("b", "one"), ("c", "two"), ("none", None), ("d", "three")]
    mapping, new = store_payloads(files(spark, rows), used, store)
    m = {r.old_handle: r.new_handle for r in mapping.collect()}
    assert set(m) == {"a", "b", "c"} and m["a"] == m["b"] != m["c"] and new.count() == 2
    again = store_payloads(files(spark, rows), used, store)[1]
    assert again.count() == 0 and spark.read.parquet(store).count() == 2
    more = store_payloads(files(spark, [*rows, ("e", "four"), ("f", "two")]), spark.createDataFrame([("e",), ("f",)], "handle string"), store)
    assert more[1].count() == 1 and {r.content for r in spark.read.parquet(store).collect()} == {"one", "two", "four"}
    # one handle, two contents: the smaller new handle, and only contents that fit their handle are stored
    twice, _ = store_payloads(files(spark, [("x", "p"), ("x", "q")]), spark.createDataFrame([("x",)], "handle string"), store + "2")
    assert twice.count() == 1
    assert twice.first().new_handle in {r.handle for r in spark.read.parquet(store + "2").collect()}


def test_unused_payloads_are_not_hashed_and_the_wide_table_moves_once(spark):
    from curatio.plans.attachments import rehome, substitute_handles

    att = files(spark, [("a", "one"), ("b", "two")])
    used = spark.createDataFrame([("a",)], "handle string")
    assert [r.old_handle for r in rehome(att, used).collect()] == ["a"]
    plan = rehome(att, used)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("sha2") < plan.index("LeftSemi")  # the join is below the hash
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wide = spark.range(20).selectExpr("id", "IF(id % 4 = 0, NULL, IF(id % 2 = 0, 'a', 'b')) AS `x.1`", "IF(id % 5 = 0, 'a', NULL) AS y", "id AS payload")
        out = substitute_handles(wide, spark.createDataFrame([("a", "A"), ("b", "B")], "old_handle string, new_handle string"), ["x.1", "y"])
        text = out._jdf.queryExecution().executedPlan().toString()
        got = {r.id: (r["x.1"], r.y) for r in out.collect()}
        assert got == {i: (None if i % 4 == 0 else "A" if i % 2 == 0 else "B", "A" if i % 5 == 0 else None) for i in range(20)}
        assert out.columns == wide.columns
        moved = [ln for ln in text.split("\n") if "Exchange" in ln]
        assert sum("hashpartitioning(__old#" in ln for ln in moved) <= 3  # the wide side once, the structs before and after
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_documents_store_is_idempotent(spark):
    from curatio.plans.attachments import choice_documents, store_documents

    store = os.path.join(tempfile.mkdtemp(), "docs")
    df = spark.createDataFrame([("1", '["a"]'), ("2", '["a"]'), ("3", "not json"), ("4", None), ("5", '["b"]')], "recordId string, cell string")
    assert store_documents(choice_documents(df, "cell"), store).count() == 2
    assert store_documents(choice_documents(df, "cell"), store).count() == 0
    assert sorted(r.document for r in spark.read.parquet(store).collect()) == ['["a"]', '["b"]']


def test_release_is_all_or_nothing(spark):
    from pyspark.sql import functions as F

    from curatio.plans.manifest import current, manifest, publish_set, read_current

    root = tempfile.mkdtemp(prefix="curatio-set-")
    a, b = spark.range(3).toDF("x"), spark.range(5).toDF("y")
    with pytest.raises(LookupError):
        read_current(spark, root, "a")
    publish_set(spark, root, "r1", {"a": a, "b": b}, {"a": ["s1"], "b": ["s1", "s2"]}, "code", "2020-01-02")
    rows = {r.target: r for r in current(spark, root).collect()}
    assert rows["a"].n_rows == 3 and rows["b"].used == ["s1", "s2"] and str(rows["a"].as_of).startswith("2020-01-02")
    # killed between the writes: the first table is there, the second is not, the manifest is as it was
    broken = b.select(F.when(F.col("y") < 0, F.col("y")).otherwise(F.raise_error(F.lit("killed")).cast("bigint")).alias("y"))
    with pytest.raises(Exception, match="killed"):
        publish_set(spark, root, "r2", {"a": spark.range(9).toDF("x"), "b": broken}, {})
    assert os.path.isdir(os.path.join(root, "runs/r2/a"))
    assert read_current(spark, root, "a").count() == 3 and manifest(spark, root).count() == 2
    # its rerun leaves one version, and once committed a run is not written again
    publish_set(spark, root, "r2", {"a": spark.range(7).toDF("x"), "b": b}, {})
    assert read_current(spark, root, "a").count() == 7
    assert publish_set(spark, root, "r2", {"a": a}, {}).count() == 2
    assert read_current(spark, root, "a").count() == 7 and manifest(spark, root).count() == 4
    with pytest.raises(LookupError):
        read_current(spark, root, "c")


def test_ordered_parts_spread_the_hot_key(spark):
    from pyspark.sql import functions as F

    from curatio.operators.aggregates import first_appearance, join_parts, ordered_distinct_concat, ordered_parts

    # the NULL participant has most of the values
    df = spark.range(3000).selectExpr("IF(id % 10 < 7, NULL, CAST(id % 3 AS STRING)) AS k", "CAST(id * 7919 % 1500 AS STRING) AS v", "id AS o")
    parts = ordered_parts(first_appearance(df, ["k"], "v", ["o"]), ["k"], "t", size=100, rows=200)
    hot = parts.where("k IS NULL").collect()
    assert len(hot) > 5 and max(r.t.count(",") + 1 for r in hot) <= 100
    got = {r.k: r.t for r in join_parts(parts, ["k"], "t").collect()}
    want = {}
    for r in df.orderBy("o").collect():
        if r.v not in want.setdefault(r.k, []):
            want[r.k].append(r.v)
    assert got == {k: ",".join(v) for k, v in want.items()}
    assert {r.k: r.t for r in ordered_distinct_concat(df, ["k"], "v", ["o"], "t").collect()} == got
    assert ordered_distinct_concat(df.where(F.lit(False)), ["k"], "v", ["o"], "t").count() == 0


def test_attachments_are_files_of_their_own_by_either_writer(spark, tmp_path, monkeypatch):
    from curatio.sources import catalog as CT

    texts = {-1: "", **{i: f"text\n{i} é" for i in range(700)}}
    df = spark.createDataFrame(list(texts.items()), "handle bigint, value string").repartition(3)
    want = {str(h): (t + "\n").encode() for h, t in texts.items()}
    for plain in (True, False):
        with monkeypatch.context() as m:
            if not plain:
                m.setattr(CT, "local_folder", lambda *_: None)
            at = f"file://{tmp_path}/{plain}"
            some = df if plain else df.where("handle < 20")
            CT.write_attachments(some, at)
        got = CT.attachment_files(spark, at, "*.txt", CT.ATTACHMENT)
        assert {r.handle: bytes(r.content) for r in got.collect()} == {h: t for h, t in want.items() if plain or int(h) < 20}
    # a process for each file's mode is what took the time: Hadoop's writer leaves a checksum file beside each
    files = [f for _, _, names in os.walk(tmp_path / "True") for f in names]
    assert len(files) == len(texts) and all(f.startswith("handle=") for f in files)
    # 701 files are 22 tasks as Spark deals them
    assert CT.attachment_files(spark, f"file://{tmp_path}/True", "*.txt", CT.ATTACHMENT).rdd.getNumPartitions() <= 16


def test_rows_of_a_handle_in_one_task_are_one_file(spark, tmp_path):
    from curatio.sources import catalog as CT

    df = spark.createDataFrame([("7", "a"), ("8", "b"), ("7", "c")], "handle string, value string")
    CT.write_attachments(df.coalesce(1), str(tmp_path / "one"))
    got = CT.attachment_files(spark, str(tmp_path / "one"), "*.txt", CT.ATTACHMENT).collect()
    assert sorted((r.handle, bytes(r.content)) for r in got) == [("7", b"a\nc\n"), ("8", b"b\n")]
