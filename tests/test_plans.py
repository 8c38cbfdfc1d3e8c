"""Plan properties that matter at scale, checked on the physical plans."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from curatio.operators.quantiles import group_quantiles
from curatio.operators.segmented import segmented

SF = "/root/testdata/sf0.001"
QUERIES = entry.queries()


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_unscalable_operators(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    for bad in ("BatchEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{name}: {bad}"
    # a single-partition exchange is only acceptable under a global aggregate, where each map
    # task sends one partially aggregated row
    if "Exchange SinglePartition" in plan:
        assert "HashAggregate(keys=[]" in plan, f"{name}: single-partition exchange outside a global aggregate"


def test_start_date_filter_reaches_parquet_scan(spark):
    plan = plan_of(QUERIES["curate_standard"](spark, SF))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate,1998-08-14T00:00)]" in plan


def test_segmented_partitions_by_record_and_chunk(spark):
    df = spark.range(1000).selectExpr("id % 3 AS rec", "CAST(id AS DOUBLE) AS t", "sin(id) AS x")
    plan = plan_of(segmented(df, ["rec"], ["t"], rows=100, lags={"x": [1]}, running={"x": "cx"}))
    # rows by the (record, chunk) struct, summary by record; the rows are not dealt again for the join
    assert "hashpartitioning(__key#" in plan and "hashpartitioning(__k0#" in plan
    assert "struct(k0," in plan
    assert plan.count("Exchange hashpartitioning") <= 4
    assert "Exchange SinglePartition" not in plan


def test_histogram_quantiles_avoid_percentile_buffers(spark):
    df = spark.range(1000).selectExpr("id % 3 AS g", "sin(id) AS v")
    plan = plan_of(group_quantiles(df, ["g"], "v", [0.5], ["median"]))
    assert "percentile" not in plan.lower()


def test_latest_profile_single_exchange(spark):
    plan = plan_of(QUERIES["latest_profile"](spark, SF))
    assert plan.count("Exchange hashpartitioning") == 1
