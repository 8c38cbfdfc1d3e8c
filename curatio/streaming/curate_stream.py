"""The standard curate steps on a streaming source.

The reference has no streaming code.  Every step of the standard pipeline
(study-start filter, null-safe exclusion of listed participants, consent
filter, de-identifying drop) is stateless per row, so the same operators
run on a streaming DataFrame: the lists join as static sides of a
stream-static anti join, and no state store is needed.  New survey files
landing in a folder are curated incrementally into a Parquet release; the
checkpoint folder makes the query restartable after a lost executor or
driver (exactly-once file sink).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from curatio.functions.rules import SHARE_ALL, START_DATE
from curatio.operators.columns import drop_if_present, skip_columns
from curatio.operators.filters import consented, since
from curatio.operators.joins import exclude
from curatio.plans.curate import RAW_COLUMN, TableSpec


def curate_stream_frame(
    stream: DataFrame,
    spec: TableSpec,
    excluded: DataFrame,
    withdrew: DataFrame,
    start: str = START_DATE,
    participant: str = "healthCode",
    scope: str = "userSharingScope",
    share_value: str = SHARE_ALL,
) -> DataFrame:
    """Apply the stateless part of ``curate`` to one streaming source.

    Version unions and row de-duplication are not applied here: the first
    needs all versions at once, the second would need unbounded state.
    """
    if spec.dedup:
        raise ValueError(f"{spec.name}: row de-duplication needs state; curate this table in batch")
    df = skip_columns(stream, (RAW_COLUMN,))
    df = since(df, spec.date_col, start)
    df = exclude(df, excluded, participant, "healthCode")
    df = exclude(df, withdrew, participant, "healthCode")
    df = consented(df, scope, share_value)
    if spec.keep is not None:
        from curatio.operators.columns import select_allowlist

        return select_allowlist(df, spec.keep, spec.keep_renames)
    return drop_if_present(df, *spec.drop)


def start_curate_stream(
    spark: SparkSession,
    source_path: str,
    schema: T.StructType | str,
    spec: TableSpec,
    excluded: DataFrame,
    withdrew: DataFrame,
    sink_path: str,
    checkpoint_path: str,
    available_now: bool = True,
    **kw,
) -> StreamingQuery:
    """Start the incremental curate query: Parquet files in ``source_path`` ->
    curated Parquet files in ``sink_path``.  ``available_now`` processes what
    is there and stops (batch-like runs); otherwise it keeps polling."""
    stream = spark.readStream.schema(schema).parquet(source_path)
    out = curate_stream_frame(stream, spec, excluded, withdrew, **kw)
    writer = out.writeStream.format("parquet").option("checkpointLocation", checkpoint_path).outputMode("append")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(sink_path)
