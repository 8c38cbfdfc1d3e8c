"""Session helpers: partition sizing and reliable lineage cuts."""

from curatio.session import checkpoint_dir, cut_lineage, scale_conf


def test_scale_conf_sizes_and_caps_partitions():
    small = scale_conf(10 * 2**30, cores=8)                   # 10 GiB -> 40 partitions of 256 MiB
    assert small["spark.sql.shuffle.partitions"] == "40"
    assert scale_conf(2**20, cores=8)["spark.sql.shuffle.partitions"] == "16"  # at least 2 x cores
    assert scale_conf(100 * 2**40)["spark.sql.shuffle.partitions"] == str(400 * 2**10)
    assert scale_conf(100 * 2**40, most=1000)["spark.sql.shuffle.partitions"] == "1000"
    assert small["spark.sql.files.maxPartitionBytes"] == str(256 << 20)


def test_cut_lineage_checkpoints_into_the_configured_folder(spark):
    folder = checkpoint_dir(spark)  # set by the test fixture, as a cluster would
    df = spark.range(100).selectExpr("id", "id * 2 AS y").where("id % 3 = 0")
    cut = cut_lineage(df)
    assert sorted(r.id for r in cut.collect()) == list(range(0, 100, 3))
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" not in plan  # the lineage above the checkpoint is gone
    assert folder
