"""Operator and rule semantics on hand-made rows (FIXTURES section 2)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from curatio.functions import expr as X
from curatio.functions import rules as R
from curatio.operators import aggregates as A
from curatio.operators import columns as C
from curatio.operators import filters as D
from curatio.operators import joins as E
from curatio.operators import reshape as G


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect()) if cols else sorted(tuple(r) for r in df.collect())


def test_exclude_null_participant_kept_without_null_in_list(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "healthCode string, v int")
    lst = spark.createDataFrame([("a",)], "healthCode string")
    assert rows(E.exclude(df, lst, "healthCode"), "v") == [(2,), (3,)]


def test_exclude_null_participant_removed_with_null_in_list(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "healthCode string, v int")
    lst = spark.createDataFrame([("a",), (None,)], "healthCode string")
    assert rows(E.exclude(df, lst, "healthCode"), "v") == [(3,)]


def test_exclude_plans_hash_join(spark):
    df = spark.range(100).selectExpr("CAST(id AS STRING) AS healthCode")
    lst = spark.createDataFrame([("1",)], "healthCode string")
    # default: no hint; AQE re-plans to a broadcast once it has measured the list
    out = E.exclude(df, lst, "healthCode")
    assert len(out.collect()) == 99
    final = out._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in final and "BroadcastHashJoin" in final and "LeftAnti" in final
    assert "NestedLoop" not in final and "Cartesian" not in final


def test_case_option_of_list_joins(spark):
    df = spark.createDataFrame([("aB", 1), ("b", 2), (None, 3)], "healthCode string, v int")
    lst = spark.createDataFrame([("Ab",), ("ab",)], "healthCode string")
    assert rows(E.exclude(df, lst, "healthCode", ignore_case=True), "v") == [(2,), (3,)]
    assert rows(E.exclude(df, lst, "healthCode"), "v") == [(1,), (2,), (3,)]
    assert rows(E.retain(df, lst, "healthCode", ignore_case=True), "v") == [(1,)]
    marked = E.mark_member(df, lst, "healthCode", "hit", ignore_case=True)
    assert rows(marked.where("hit"), "v") == [(1,)] and marked.count() == 3


def test_side_list_by_name(spark, tmp_path):
    from curatio.sources.catalog import read_side_list

    (tmp_path / "list.csv").write_text("note,healthCode,round\nx,bad1,1\ny,bad2,2\n")
    assert rows(read_side_list(spark, str(tmp_path / "list.csv")), "healthCode") == [("bad1",), ("bad2",)]
    (tmp_path / "other.csv").write_text("note\nx\n")
    with pytest.raises(ValueError):
        read_side_list(spark, str(tmp_path / "other.csv"))


def test_a_handle_listed_twice_keeps_one_row(spark):
    from curatio.plans.attachments import substitute_handles

    df = spark.createDataFrame([(1, "h", "g"), (2, "k", None)], "v int, a string, b string")
    m = spark.createDataFrame([("h", "n2"), ("h", "n1"), ("g", "n3")], "old_handle string, new_handle string")
    got = sorted(tuple(r) for r in substitute_handles(df, m, ["a", "b"]).collect())
    assert got == [(1, "n1", "n3"), (2, None, None)]


def test_bands_add_up(spark):
    from curatio.sensors.spectral import band_energies

    s = spark.createDataFrame([(1, 10.0, 1.0), (1, 30.0, 99.0), (1, 24.9, 5.0)], "k int, freq double, power double")
    r = band_energies(s, ["k"]).first().asDict()
    assert sum(v for n, v in r.items() if n != "k" and v) == 105.0 and r["EnergyBandAbove"] == 99.0


def test_semi_and_anti_partition_the_input(spark):
    df = spark.range(50).selectExpr("CAST(id % 7 AS STRING) AS k", "id")
    lst = spark.createDataFrame([("1",), ("3",), (None,)], "k string")
    kept = E.retain(df, lst, "k").count()
    dropped = E.exclude(df, lst, "k").count()
    assert kept + dropped == 50


def test_since_is_inclusive_at_midnight(spark):
    df = spark.createDataFrame(
        [(1, dt.datetime(2017, 8, 14, 0, 0, 0)), (2, dt.datetime(2017, 8, 13, 23, 59, 59, 999000)), (3, None)],
        "id int, createdOn timestamp",
    )
    assert rows(D.since(df, "createdOn", "2017-08-14"), "id") == [(1,)]


def test_consent_null_scope_removed(spark):
    df = spark.createDataFrame([(1, "ALL_QUALIFIED_RESEARCHERS"), (2, None), (3, "SPONSORS_AND_PARTNERS")],
                               "id int, userSharingScope string")
    assert rows(D.consented(df), "id") == [(1,)]


def test_not_in_treats_null_as_not_member(spark):
    df = spark.createDataFrame([(1, "no"), (2, None), (3, "yes")], "id int, d string")
    assert rows(D.not_member_of(df, "d", ["no", "notsure"]), "id") == [(2,), (3,)]


def _participants(spark, data):
    schema = ("dataGroups string, currentDiagnosis string, currentDiagnosisYear string, currentDMT string, "
              "firstDMTYear string, overallPhysicalAbility string, referred_by_clinician boolean, externalId string")
    df = spark.createDataFrame(data, schema)
    df = df.withColumn("error", R.cohort_error_code())
    return df.withColumn("group2", R.reassign_cohort("dataGroups", "error"))


def test_consistency_rules(spark):
    df = _participants(spark, [
        ("control", None, None, None, None, None, False, None),      # NULL diagnosis -> Ignore
        ("control", "no", None, None, None, None, False, None),      # stays control
        ("control", "no", None, None, None, None, False, "x1"),      # referred -> ms_patient
        (None, "yes", "2010", None, None, None, None, None),         # NA with MS params
        ("", None, None, None, None, None, None, None),              # NA
        ("ms_patient", "yes", "2010", None, None, None, True, None), # consistent
    ])
    got = [r.group2 for r in df.collect()]
    assert got == ["Ignore", "control", "ms_patient", "Ignore", "Ignore", "ms_patient"]


def test_reference_mode_history_a_b_a(spark):
    # value history A -> B -> A: keep-first per value drops the second A, latest is B
    df = spark.createDataFrame(
        [("p", "A", dt.date(2018, 1, 1), 1), ("p", "B", dt.date(2018, 2, 1), 2), ("p", "A", dt.date(2018, 3, 1), 3)],
        "healthCode string, v string, d date, seq int",
    )
    kf = A.keep_first(df, ["healthCode", "v"], ["seq"])
    latest = kf.groupBy("healthCode").agg(A.latest_nonnull("v", ["d", "seq"]).alias("v"))
    assert latest.collect()[0].v == "B"
    direct = df.groupBy("healthCode").agg(A.latest_nonnull("v", ["d", "seq"]).alias("v"))
    assert direct.collect()[0].v == "A"


def test_latest_ties_on_date_take_later_row_and_all_null_is_null(spark):
    df = spark.createDataFrame(
        [("p", "x", dt.date(2018, 1, 1), 1), ("p", "y", dt.date(2018, 1, 1), 2), ("q", None, dt.date(2018, 1, 1), 3)],
        "k string, v string, d date, seq int",
    )
    out = dict(df.groupBy("k").agg(A.latest_nonnull("v", ["d", "seq"]).alias("v")).collect())
    assert out == {"p": "y", "q": None}


def test_keep_first_is_idempotent(spark):
    df = spark.range(200).selectExpr("id % 13 AS k", "id % 5 AS v", "id AS seq")
    once = A.keep_first(df, ["k"], ["v", "seq"])
    twice = A.keep_first(once, ["k"], ["v", "seq"])
    assert rows(once) == rows(twice)


def test_ordered_distinct_concat_first_appearance(spark):
    df = spark.createDataFrame([("p", "b", 1), ("p", "a", 2), ("p", "b", 3), ("p", None, 4), ("p", "c", 5)],
                               "k string, v string, s int")
    out = A.ordered_distinct_concat(df, ["k"], "v", ["s"], "vals").collect()[0].vals
    assert out == "b,a,c"


def test_unpivot_then_pivot_is_identity(spark):
    df = spark.createDataFrame([(1, "a", "b"), (2, None, "d")], "id int, x string, y string")
    long = G.unpivot(df, ["id"], ["x", "y"], "k", "v")
    back = G.pivot(long, ["id"], "k", "v", ["x", "y"])
    assert rows(back, "id", "x", "y") == rows(df, "id", "x", "y")


def test_flags_to_list_in_column_order_and_race_rules(spark):
    df = spark.createDataFrame(
        [("p", True, False, True), ("p", False, True, False), ("q", True, False, False), ("r", False, False, False)],
        "healthCode string, `race.asian` boolean, `race.pacific_islander` boolean, `race.caucasian` boolean",
    )
    out = G.flags_to_list(df, "healthCode", ["race.asian", "race.pacific_islander", "race.caucasian"], r"race.", "race")
    out = out.withColumn("h", R.harmonise_race("race"))
    got = {r.healthCode: (r.race, r.h) for r in out.collect()}
    assert got == {"p": ("asian,pacific_islander,caucasian", "caucasian"), "q": ("asian", "asian")}
    two = spark.createDataFrame([("asian,pacific_islander",)], "race string").select(R.harmonise_race("race"))
    assert two.collect()[0][0] == "asian"


def test_half_even_rounding(spark):
    df = spark.createDataFrame([(0.125,), (1 / 8 * 100,)], "x double")
    assert [r[0] for r in df.select(X.half_even("x", 2)).collect()] == [0.12, 12.5]


def test_bad_year_is_null(spark):
    df = spark.createDataFrame([("abc",), ("2010",)], "y string")
    got = [r[0] for r in df.select(X.years_since("y", "2020-06-30")).collect()]
    assert got == [None, 10.0]


def test_json_array_cell(spark):
    df = spark.createDataFrame([('["a","b"]',), ("bad",), (None,)], "j string")
    got = [r[0] for r in df.select(X.json_string_array("j")).collect()]
    assert got == [["a", "b"], None, None]


def test_regex_rename_collision_detected(spark):
    df = spark.createDataFrame([(1, 2)], "`a.json.answer` int, `a` int")
    try:
        C.regex_rename(df, ".json.answer", "")
    except ValueError:
        return
    raise AssertionError("collision not detected")


def test_project_to_schema_and_conformance(spark):
    from pyspark.sql import types as T

    df = spark.createDataFrame([("1", "x"), ("2", "3")], "a string, b string")
    target = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType()),
                           T.StructField("c", T.StringType())])
    out = C.project_to_schema(df, target)
    assert out.dtypes == [("a", "int"), ("b", "int"), ("c", "string")]
    assert rows(out) == [(1, None, None), (2, 3, None)]
    rep = {r.column_name: (r.present, r.bad_values) for r in C.conformance_report(df, target).collect()}
    assert rep == {"a": (True, 0), "b": (True, 1), "c": (False, None)}


def test_postcode_first_state_by_zip(spark):
    from curatio.plans.baseline import postcode_states

    zips = spark.createDataFrame([("10002", "NY"), ("10001", "NJ"), ("20001", "DC")], "zip string, state string")
    states = spark.createDataFrame([("NY", "New York"), ("NJ", "New Jersey")], "state string, `state.name` string")
    got = {r.zipcode_firstThree: r.state for r in postcode_states(zips, states).collect()}
    assert got == {"100": "New Jersey"}
