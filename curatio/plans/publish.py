"""Typed publishing and lineage rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curatio.operators.columns import conformance_report, project_to_schema

PROVENANCE_SCHEMA = T.StructType(
    [
        T.StructField("target", T.StringType(), False),
        T.StructField("used", T.ArrayType(T.StringType(), False), False),
        T.StructField("executed", T.StringType(), True),
        T.StructField("n_rows", T.LongType(), False),
        T.StructField("as_of", T.TimestampType(), False),
    ]
)


def publish(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite",
            fmt: str = "parquet") -> None:
    """Write a release table with the types Spark inferred (B1).

    Spark's file commit protocol makes the write atomic per job; a lost
    executor's tasks are re-run from lineage before commit.
    """
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def publish_typed(df: DataFrame, target: T.StructType, path: str, drop: Iterable[str] = (),
                  strict: bool = True, **kw) -> DataFrame:
    """Project onto a target schema, check conformance, then write.

    With ``strict``, a target column with values that do not cast raises
    before anything is written; a column absent from the data is written as
    NULL (the reference's tremor quirk).  Returns the conformance report.
    """
    report = conformance_report(df.drop(*[d for d in drop if d in df.columns]),
                                T.StructType([f for f in target.fields if f.name not in set(drop)]))
    if strict:
        bad = report.where(F.col("bad_values") > 0).limit(1).collect()
        if bad:
            raise ValueError(f"column {bad[0]['column_name']!r} has values that do not fit {bad[0]['target_type']}")
    publish(project_to_schema(df, target, drop), path, **kw)
    return report


def provenance_with_count(df: DataFrame, target: str, used: Sequence[str], executed: str | None, as_of=None) -> DataFrame:
    """One lineage row of ``PROVENANCE_SCHEMA`` (B6); the row count is one global aggregate of ``df``.

    ``as_of``: the time the table holds for, by default now.
    """
    row = df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(target).alias("target"),
        F.array(*[F.lit(u) for u in used]).cast("array<string>").alias("used"),
        F.lit(executed).cast("string").alias("executed"),
        "n_rows",
        (F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")).alias("as_of"),
    )
    return row.select(*[f.name for f in PROVENANCE_SCHEMA])


def append_provenance(row: DataFrame, path: str) -> None:
    row.write.mode("append").parquet(path)
