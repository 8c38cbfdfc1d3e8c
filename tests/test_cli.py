"""The command-line release jobs on small Parquet inputs."""

import datetime as dt
import os
import tempfile

from curatio.__main__ import main
from curatio.plans.curate import SPECS
from tests.test_specs import frame_for

T0 = dt.datetime(2018, 1, 1)


def _csv(spark, path, rows):
    spark.createDataFrame(rows, "healthCode string").write.option("header", True).csv(path)


def test_cli_release_and_trials(spark):
    root = tempfile.mkdtemp(prefix="curatio-cli-")
    spec = SPECS["tapping"]
    for i, s in enumerate(spec.sources):
        frame_for(spark, spec, s, i).write.parquet(os.path.join(root, "tables", f"{s.table}.parquet"))
    _csv(spark, os.path.join(root, "ex"), [("bad",)])
    _csv(spark, os.path.join(root, "wd"), [("gone",)])
    out = os.path.join(root, "out")
    main(["release", "tapping", "--tables", os.path.join(root, "tables"), "--excluded", os.path.join(root, "ex"),
          "--withdrew", os.path.join(root, "wd"), "--out", out, "--typed", "--executed", "cli-test"])
    assert spark.read.parquet(os.path.join(out, "tapping")).count() == 4
    assert spark.read.parquet(os.path.join(out, "provenance")).collect()[0].n_rows == 4

    trials = spark.createDataFrame([("e1", "b", T0, "y", 1000.0), ("e1", "b", T0, "n", 3000.0)],
                                   "externalId string, blockId string, createdOn timestamp, accuracy string, durationMS double")
    trials.write.parquet(os.path.join(root, "trials"))
    spark.createDataFrame([("e1", "p1")], "externalId string, healthCode string").write.parquet(os.path.join(root, "cw"))
    spark.createDataFrame([("p1",)], "healthCode string").write.parquet(os.path.join(root, "cohort"))
    main(["trials", "--trials", os.path.join(root, "trials"), "--crosswalk", os.path.join(root, "cw"),
          "--cohort", os.path.join(root, "cohort"), "--excluded", os.path.join(root, "ex"),
          "--withdrew", os.path.join(root, "wd"), "--out", out])
    r = spark.read.parquet(os.path.join(out, "symbol_substitution_test")).collect()[0]
    assert (r.healthCode, r.numDigits, r.percentCorrect, r.avgTime, r.totalTime) == ("p1", 2, 50.0, 2.0, 4.0)
