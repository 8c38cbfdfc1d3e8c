"""The corpus pipeline: quality, near-duplicates, repeated passages, benchmark passages, mixture."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatio.llm import decontaminate as dc
from curatio.llm import mixing as mx
from curatio.llm import neardup as nd
from curatio.llm import quality as ql
from curatio.llm import substrings as ss
from curatio.llm.common import durable
from curatio.sources.testtables import table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    return ql.classify(docs.select(*COLUMNS), "__q").where(F.col("__q.keep")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group, the smallest id's.

    Groups are of rows, not of ids: each row has a handle of its own, so repeated rows and rows without an id are
    parted by their words like all others.  Rows without words are in no group; only repeats of their id go.
    """
    # written, so that a recomputed task cannot number the rows anew
    d = durable(docs.select(*COLUMNS).withColumn("__row", F.monotonically_increasing_id()))
    found = nd.near_duplicates(d.select("__row", "text"), doc_id="__row").withColumnRenamed("doc_id", "__row")
    group = F.when((F.col("n_shingles") > 0) | F.col("doc_id").isNull(), F.col("component_id"))
    named = found.join(d.select("__row", "doc_id"), "__row")
    named = named.select("__row", "doc_id", group.alias("group"), F.when(group.isNull(), F.col("doc_id")).alias("id"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__row")).alias("first")
    stays = named.groupBy("group", "id").agg(first).select(F.col("first.__row").alias("__row"))
    return d.join(stays, "__row", "left_semi").select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words that repeated windows cover."""
    d = ss.remove_repeats(docs.select(*COLUMNS), "__r").withColumn("text", F.col("__r.kept"))
    return d.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    d = dc.decontaminate(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"), "__hit")
    return d.where(~dc.contaminated(F.col("__hit"))).select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mixture takes of each document that is left."""
    return mx.taken(mx.mix(docs)).select("doc_id", F.col("src").alias("source"), "size", "source_size", "target", "taken")


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontamination", decontamination),
    ("mixing", mixing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the documents; each stage's rows are written and reread."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir))
    return docs


# Learned and drawn decisions are beyond SQL; the tests hold the three stages between them against brute force.
ORACLE_SQL: str | None = None
