"""Access to the driver's Parquet test tables and stand-in inputs built from them.

A *stand-in* only reshapes test-table rows into the schema a job expects
(column names, a consent value per row, a few NULLs); it performs none of
the job's work.  The same SQL text is run by Spark (to feed the library)
and by DuckDB (inside the oracle query), so both sides see identical
inputs.  Identifiers in stand-in SQL use back-ticks; ``duck()`` converts
them to double quotes for DuckDB.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


_REGISTERED: dict[tuple[str, str], str] = {}


def register(spark: SparkSession, sf_dir: str, names=None) -> None:
    """Register test tables as temp views (names as the oracle sees them).

    A view is re-created only when it points at another folder, so repeated
    stand-ins do not re-read Parquet footers.
    """
    try:
        app = spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - no SparkContext (Spark Connect)
        app = str(id(spark))
    for n in names or TABLES:
        if _REGISTERED.get((app, n)) == sf_dir and spark.catalog.tableExists(n):
            continue
        table(spark, sf_dir, n).createOrReplaceTempView(n)
        _REGISTERED[(app, n)] = sf_dir


def referenced(sql: str) -> list[str]:
    """Test tables named in a SQL text."""
    return [t for t in TABLES if re.search(rf"\b{t}\b", sql)]


def standin(spark: SparkSession, sf_dir: str, sql: str, names=None) -> DataFrame:
    register(spark, sf_dir, names or referenced(sql))
    return spark.sql(sql)


def duck(sql: str) -> str:
    """Stand-in SQL in DuckDB's identifier quoting."""
    return sql.replace("`", '"')
