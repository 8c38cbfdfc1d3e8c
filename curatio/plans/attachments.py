"""Attachment re-homing and choice-answer documents.

The reference downloads every attachment of every row, uploads copies one
by one and swaps the handles.  Here the payloads live in an
``attachments(handle, content)`` table and the release area is a store addressed
by content:

* new handle = SHA-256 of the payload, so identical payloads share one copy and
  a re-run yields the same handles;
* ``store_payloads`` adds to the store what it does not hold yet: handles are
  compared first, on narrow rows, one owner among the files of equal content is
  chosen, and only then are the missing contents read and written;
* all handle columns of a table are replaced in one join; a handle whose
  payload is missing becomes NULL (the reference's failed upload).

Each join is on a handle with no broadcast hint: the attachments side has
one row per file, so at scale Spark's size check plans a shuffle join (AQE
converts it to a broadcast only when the measured side is small).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from curatio.functions.expr import c, content_handle, json_string_array
from curatio.session import written


def used_handles(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The distinct handles in any of ``columns``, one row each."""
    return df.select(F.explode(F.array(*[c(n) for n in columns])).alias("handle")).where(F.col("handle").isNotNull()).distinct()


def rehome(attachments: DataFrame, used: DataFrame | None = None, handle: str = "handle", content: str = "content") -> DataFrame:
    """Map old handle -> new content handle for every available payload.

    With ``used`` (column ``handle``, distinct) only payloads named there are hashed.
    """
    a = attachments.where(c(content).isNotNull())
    if used is not None:
        a = a.join(used.select(c("handle").alias("__h")), c(handle) == F.col("__h"), "left_semi")
    return a.select(c(handle).alias("old_handle"), content_handle(content).alias("new_handle"))


def one_new(mapping: DataFrame) -> DataFrame:
    """One row an old handle: the smallest of its new ones."""
    return mapping.groupBy("old_handle").agg(F.min("new_handle").alias("new_handle"))


def owners(mapping: DataFrame) -> DataFrame:
    """One row a new handle: the smallest old handle of that content, whose file is the one to copy."""
    return mapping.groupBy("new_handle").agg(F.min("old_handle").alias("old_handle"))


def release_payloads(attachments: DataFrame, mapping: DataFrame, handle: str = "handle", content: str = "content") -> DataFrame:
    """Rows ``(handle, content)`` for the release store, one per new handle of ``mapping``.

    The owner's file is read again and checked against its handle; repeated
    rows of one file are one, on the join's own partitioning.
    """
    own = owners(mapping).withColumnsRenamed({"new_handle": "__new", "old_handle": "__old"})
    files = attachments.where(c(content).isNotNull()).select(c(handle).alias("__h"), c(content).alias("content"))
    got = files.join(own, F.col("__h") == F.col("__old")).where(content_handle("content") == F.col("__new"))
    return got.dropDuplicates(["__h"]).select(F.col("__new").alias("handle"), "content")


def stored(spark: SparkSession, store: str) -> DataFrame | None:
    """The handles a store holds; None for a store not written yet."""
    try:
        return spark.read.parquet(store).select("handle")
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def store_payloads(attachments: DataFrame, used: DataFrame | None, store: str, handle: str = "handle",
                   content: str = "content") -> tuple[DataFrame, DataFrame]:
    """Add the payloads of ``used`` handles to ``store``; return the mapping old -> new and the handles added.

    A re-run adds nothing.  The append is one atomic Spark job.
    """
    spark = attachments.sparkSession
    mapping = written(rehome(attachments, used, handle, content), "handles")
    have = stored(spark, store)
    missing = mapping if have is None else mapping.join(have.select(F.col("handle").alias("new_handle")), "new_handle", "left_anti")
    new = written(owners(missing).select("old_handle", "new_handle"), "owners")
    if not new.isEmpty():
        release_payloads(attachments, new, handle, content).write.mode("append").parquet(store)
    return one_new(mapping), new.select(F.col("new_handle").alias("handle"))


def store_documents(documents: DataFrame, store: str) -> DataFrame:
    """Add rows ``(handle, document)`` that ``store`` lacks; return the handles added."""
    d = documents.where(F.col("handle").isNotNull()).groupBy("handle").agg(F.min("document").alias("document"))
    have = stored(documents.sparkSession, store)
    d = written(d if have is None else d.join(have, "handle", "left_anti"), "documents")
    if not d.isEmpty():
        d.write.mode("append").parquet(store)
    return d.select("handle")


def substitute_handles(df: DataFrame, mapping: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace each handle column by its new handle; unmatched -> NULL.

    A handle that the mapping holds several times has its smallest new one, so
    no row is doubled.  The handles of a row are one struct: the distinct structs
    are taken apart into (struct, column, handle), joined once with the mapping and put together again, and the
    table meets the result in one join on the struct.
    """
    columns = list(columns)
    if not columns:
        return df
    fields = [f"h{i}" for i in range(len(columns))]
    old = F.struct(*[c(n).alias(f) for f, n in zip(fields, columns)])
    # a row without handles has a NULL key: it meets nothing
    key = F.when(reduce(lambda a, b: a | b, [c(n).isNotNull() for n in columns]), old)
    out = df.withColumn("__old", key)
    parts = out.select("__old").where(F.col("__old").isNotNull()).distinct()
    parts = parts.select("__old", F.posexplode(F.array(*[F.col(f"__old.{f}") for f in fields])).alias("__at", "old_handle"))
    parts = parts.where(F.col("old_handle").isNotNull()).join(one_new(mapping), "old_handle")
    new = parts.groupBy("__old").agg(*[F.max(F.when(F.col("__at") == i, F.col("new_handle"))).alias(f"__new{i}") for i in range(len(columns))])
    # a struct with a NULL field is not NULL itself, and its fields compare null-safely
    out = out.join(new, "__old", "left")
    return out.select(*[F.col(f"__new{columns.index(n)}").alias(n) if n in columns else c(n) for n in df.columns])


def choice_documents(df: DataFrame, column: str, record: str = "recordId") -> DataFrame:
    """Parse the multi-choice JSON cell and re-serialise it as a document.

    Rows: ``recordId, choices ARRAY<STRING>, document STRING, handle STRING``.
    Malformed JSON gives NULL choices and a NULL document/handle.
    """
    parsed = df.select(c(record).alias(record), json_string_array(column).alias("choices"))
    doc = F.to_json(F.col("choices"))
    return parsed.withColumn("document", doc).withColumn(
        "handle", F.when(F.col("document").isNotNull(), content_handle(F.col("document")))
    )


def replace_choice_cell(df: DataFrame, column: str) -> DataFrame:
    """Swap the JSON cell for the handle of its document."""
    doc = F.to_json(json_string_array(column))
    return df.withColumn(column, F.when(doc.isNotNull(), content_handle(doc)))


def explode_choices(df: DataFrame, column: str, record: str = "recordId") -> DataFrame:
    """One row per (record, position, choice) - the long form of the answers."""
    return df.select(c(record).alias(record), F.posexplode(json_string_array(column)).alias("pos", "choice"))
