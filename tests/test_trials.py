import datetime as dt

from curatio.plans.trials import block_summary, trial_summary

T0 = dt.datetime(2018, 1, 1)
SCHEMA = "healthCode string, blockId string, createdOn timestamp, accuracy string, durationMS double"


def test_percent_correct_half_even(spark):
    data = [("p", "b", T0, "y" if i == 0 else "n", 1000.0) for i in range(8)]
    r = block_summary(spark.createDataFrame(data, SCHEMA)).collect()[0]
    assert (r.numDigits, r.numCorrect, r.percentCorrect) == (8, 1, 12.0)


def test_single_trial_sd_null_and_all_null_durations(spark):
    data = [("p", "b1", T0, "y", 1500.0), ("q", "b2", T0, "y", None), ("q", "b2", T0, "n", None)]
    out = {r.healthCode: r for r in block_summary(spark.createDataFrame(data, SCHEMA)).collect()}
    assert out["p"].sdTime is None and out["p"].avgTime == 1.5
    assert out["q"].totalTime == 0.0 and out["q"].avgTime is None


def test_strict_na_for_accuracy(spark):
    data = [("p", "b", T0, "y", 1.0), ("p", "b", T0, None, 1.0)]
    r = block_summary(spark.createDataFrame(data, SCHEMA)).collect()[0]
    assert r.numCorrect is None and r.percentCorrect is None
    r2 = block_summary(spark.createDataFrame(data, SCHEMA), na_strict=False).collect()[0]
    assert r2.numCorrect == 1


def test_crosswalk_fans_out_and_filters(spark):
    trials = spark.createDataFrame(
        [("e1", "b", T0, "y", 1.0), ("e2", "b", dt.datetime(2016, 1, 1), "y", 1.0)],
        "externalId string, blockId string, createdOn timestamp, accuracy string, durationMS double",
    )
    cw = spark.createDataFrame([("e1", "p1"), ("e1", "p2"), ("e1", "p2"), ("e2", "p3")], "externalId string, healthCode string")
    empty = spark.createDataFrame([], "healthCode string")
    cohort = spark.createDataFrame([("p1",), ("p2",), ("p3",)], "healthCode string")
    out = trial_summary(trials, cw, empty, empty, cohort, start="2017-08-14")
    assert sorted(r.healthCode for r in out.collect()) == ["p1", "p2"]


def test_crosswalk_natural_join_when_trials_carry_participant(spark):
    trials = spark.createDataFrame(
        [("e1", "p1", "b", T0, "y", 1.0), ("e1", "p9", "b", T0, "y", 1.0)],
        "externalId string, healthCode string, blockId string, createdOn timestamp, accuracy string, durationMS double",
    )
    cw = spark.createDataFrame([("e1", "p1"), ("e1", "p2")], "externalId string, healthCode string")
    empty = spark.createDataFrame([], "healthCode string")
    cohort = spark.createDataFrame([("p1",), ("p2",), ("p9",)], "healthCode string")
    out = trial_summary(trials, cw, empty, empty, cohort, start="2017-08-14")
    assert sorted((r.healthCode, r.numDigits) for r in out.collect()) == [("p1", 1), ("p9", 1)]
