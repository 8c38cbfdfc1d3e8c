"""The standard curate pipeline on hand-made frames shaped like the release tables."""

import datetime as dt

from curatio.plans.curate import SPECS, curate

COMMON = ("recordId string, healthCode string, createdOn timestamp, `metadata.json.startDate` timestamp, "
          "dataGroups string, externalId string, userSharingScope string, validationErrors string, "
          "substudyMemberships string, dayInStudy int, rawData string, ROW_ID bigint, ROW_VERSION bigint")
OK = dt.datetime(2018, 1, 1)
EARLY = dt.datetime(2017, 1, 1)


def _rows(extra):
    base = [
        ("r1", "p1", OK, OK, "g", "e", "ALL_QUALIFIED_RESEARCHERS", None, None, 1, "raw", 1, 1),
        ("r2", "p2", OK, EARLY, "g", "e", "ALL_QUALIFIED_RESEARCHERS", None, None, 1, "raw", 2, 1),
        ("r3", "bad", OK, OK, "g", "e", "ALL_QUALIFIED_RESEARCHERS", None, None, 1, "raw", 3, 1),
        ("r4", "p4", OK, OK, "g", "e", "SPONSORS_AND_PARTNERS", None, None, 1, "raw", 4, 1),
        ("r5", None, OK, OK, "g", "e", "ALL_QUALIFIED_RESEARCHERS", None, None, 1, "raw", 5, 1),
    ]
    return [b + e for b, e in zip(base, extra)]


def lists(spark):
    ex = spark.createDataFrame([("bad",)], "healthCode string")
    wd = spark.createDataFrame([("gone",)], "healthCode string")
    return ex, wd


def test_tapping_versions_renamed_and_filtered(spark):
    v1 = spark.createDataFrame(_rows([("h1", "h2", "x")] * 5),
                               COMMON + ", `accelerometer_tapping_left.json` string, `accelerometer_tapping_right.json` string, `metadata.json.dataGroups` string")
    v2 = spark.createDataFrame(_rows([("h3", "h4", "y")] * 5),
                               COMMON + ", `accelerometer_tapping_left.json.items` string, `accelerometer_tapping_right.json.items` string, `metadata.json.dataGroups` string")
    ex, wd = lists(spark)
    out = curate(SPECS["tapping"], {"tapping_v1": v1, "tapping_v2": v2}, ex, wd)
    assert sorted(r.recordId for r in out.collect()) == ["r1", "r1", "r5", "r5"]
    for dropped in ("dataGroups", "externalId", "userSharingScope", "rawData", "ROW_ID", "metadata.json.dataGroups"):
        assert dropped not in out.columns
    assert "accelerometer_tapping_left.json.items" in out.columns


def test_msis29_allow_list_and_rename(spark):
    cols = ", ".join(f"`{c}` string" for c in ["appVersion", "phoneInfo", "uploadDate", "createdOnTimeZone",
                                                "01_demanding_tasks", "02_grip", "03_carry_things", "04_balance",
                                                "29_confidence", "05_other"])
    df = spark.createDataFrame(_rows([tuple("abcdefghij")] * 5), COMMON + ", " + cols)
    ex, wd = lists(spark)
    out = curate(SPECS["msis29"], {"msis29": df}, ex, wd)
    assert out.columns[-1] == "29_depression" and "05_other" not in out.columns and len(out.columns) == 12


def test_passive_dedup_and_not_null(spark):
    df = spark.createDataFrame(_rows([("x",), ("x",), ("x",), ("x",), (None,)]) + _rows([("x",)] * 5)[:1],
                               COMMON + ", `pedometer.json.pedometerData` string")
    ex, wd = lists(spark)
    out = curate(SPECS["passive_pedometer"], {"passive_pedometer": df}, ex, wd)
    assert [r.recordId for r in out.collect()] == ["r1"]
