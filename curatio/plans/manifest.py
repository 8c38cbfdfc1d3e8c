"""A release of several tables that becomes visible at once.

Every table of a run is written to a staged folder of its own, ``runs/<run>/<table>``.
When all are there, one file with a row a table is added to the manifest: that
file's commit is the release.  Readers go by the manifest, so they see all tables of a
run or none of it, and never a folder that a killed job left behind.  A rerun
under the same run id overwrites what was staged, and does nothing if the run is
in the manifest already, so that one version of it exists.

The manifest row is the table's lineage row as well: sources, what was executed,
row count, and the time it holds for.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from curatio.plans.publish import PROVENANCE_SCHEMA, provenance_with_count, publish

MANIFEST_SCHEMA = T.StructType([
    *PROVENANCE_SCHEMA.fields,
    T.StructField("run", T.StringType(), False),
    T.StructField("path", T.StringType(), False),
    T.StructField("committed", T.TimestampType(), False),
])


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """All committed rows of a release folder; empty before the first release."""
    try:
        return spark.read.schema(MANIFEST_SCHEMA).parquet(f"{root.rstrip('/')}/manifest")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], MANIFEST_SCHEMA)
        raise


def current(spark: SparkSession, root: str) -> DataFrame:
    """The manifest rows of the run that was committed last (equal times: the greater run id)."""
    m = manifest(spark, root)
    last = m.orderBy(F.col("committed").desc(), F.col("run").desc()).limit(1).select("committed", "run")
    return m.join(last, ["committed", "run"], "left_semi")


def read_current(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table of the current release."""
    row = current(spark, root).where(F.col("target") == table).select("path").first()
    if row is None:
        raise LookupError(f"the current release in {root} has no table {table!r}")
    return spark.read.parquet(row["path"])


def publish_set(
    spark: SparkSession,
    root: str,
    run: str,
    tables: Mapping[str, DataFrame],
    used: Mapping[str, Sequence[str]],
    executed: str | None = None,
    as_of=None,
    partition_by: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Write ``tables`` as one release and return its manifest rows.

    ``used``: sources of each table.  ``as_of``: the time the release holds for,
    by default that of the commit.
    """
    root = root.rstrip("/")
    done = manifest(spark, root).where(F.col("run") == run)
    if not done.isEmpty():
        return done
    rows = None
    for name, df in tables.items():
        path = f"{root}/runs/{run}/{name}"
        publish(df, path, partition_by=(partition_by or {}).get(name, ()))
        row = provenance_with_count(spark.read.parquet(path), name, used.get(name, ()), executed, as_of)
        row = row.select("*", F.lit(run).alias("run"), F.lit(path).alias("path"))
        rows = row if rows is None else rows.unionByName(row)
    if rows is None:
        raise ValueError("a release needs a table")
    committed = F.lit(dt.datetime.now(dt.timezone.utc)).cast("timestamp")
    # one file: it appears when it is renamed into place, whole
    rows.withColumn("committed", committed).coalesce(1).write.mode("append").parquet(f"{root}/manifest")
    return manifest(spark, root).where(F.col("run") == run)
