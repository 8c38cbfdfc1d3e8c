"""Schema and projection operators (column-level, no shuffle)."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curatio.functions.expr import as_col, c

# System columns every remote table carries; never part of a release.
SYSTEM_COLUMNS = ("ROW_ID", "ROW_VERSION")
# Field-metadata key that marks a column as an attachment handle.
HANDLE_KIND = {"kind": "handle"}


def drop_if_present(df: DataFrame, *names: str) -> DataFrame:
    """``select(-a, -b)`` that ignores absent names (dotted names are literal)."""
    present = [n for n in names if n in df.columns]
    return df.drop(*present) if present else df


def skip_columns(df: DataFrame, skip: Iterable[str] = ("rawData",)) -> DataFrame:
    """Drop columns right after the scan so Catalyst prunes them from the read."""
    return drop_if_present(df, *SYSTEM_COLUMNS, *skip)


def select_allowlist(df: DataFrame, keep: Sequence[str], renames: Mapping[str, str] | None = None) -> DataFrame:
    """Project an allow-list in the given order; ``renames`` maps old -> new."""
    renames = dict(renames or {})
    return df.select([c(k).alias(renames.get(k, k)) for k in keep])


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """``rename(new = old)`` for the columns that exist (C4)."""
    present = {o: n for o, n in mapping.items() if o in df.columns}
    return df.withColumnsRenamed(present) if present else df


def regex_rename(df: DataFrame, pattern: str, replacement: str = "") -> DataFrame:
    """``colnames(x) <- gsub(pattern, replacement, colnames(x))`` with a collision check.

    ``pattern`` is a regular expression, so ``.`` is a wildcard exactly as in R.
    """
    new = [re.sub(pattern, replacement, n) for n in df.columns]
    dupes = sorted({n for n in new if new.count(n) > 1})
    if dupes:
        raise ValueError(f"regex rename would create duplicate columns: {dupes}")
    return df.toDF(*new)


def columns_of_type(df: DataFrame, type_name: str) -> list[str]:
    """Names of columns whose simple type string is ``type_name``.

    ``type_name='handle'`` selects attachment columns (field metadata).
    """
    if type_name == "handle":
        return [f.name for f in df.schema.fields if f.metadata.get("kind") == "handle"]
    return [n for n, t in df.dtypes if t == type_name]


def columns_matching(df: DataFrame, pattern: str) -> list[str]:
    """Names matching a regular expression (``grepl`` over column names, C7)."""
    rx = re.compile(pattern)
    return [n for n in df.columns if rx.search(n)]


def mark_handle(df: DataFrame, name: str) -> DataFrame:
    """Re-type a column as an attachment handle (C10): STRING + field metadata."""
    return df.withColumn(name, c(name).cast("string").alias(name, metadata=HANDLE_KIND))


def project_to_schema(
    df: DataFrame, target: T.StructType, drop: Iterable[str] = (), add_missing: bool = True
) -> DataFrame:
    """Typed projection onto ``target`` minus ``drop``.

    Values that do not fit the target type become NULL (``try_cast``); a
    target column absent from ``df`` becomes a typed NULL when
    ``add_missing``.  Column order follows the target.
    """
    drop = set(drop)
    cols: list[Column] = []
    for f in target.fields:
        if f.name in drop:
            continue
        if f.name in df.columns:
            src = df.schema[f.name].dataType
            expr = c(f.name) if src == f.dataType else F.expr(f"try_cast(`{f.name}` AS {f.dataType.simpleString()})")
        elif add_missing:
            expr = F.lit(None).cast(f.dataType)
        else:
            continue
        cols.append(expr.alias(f.name, metadata=f.metadata) if f.metadata else expr.alias(f.name))
    return df.select(cols)


def conformance_report(df: DataFrame, target: T.StructType) -> DataFrame:
    """Per target column: present in ``df``, non-NULL values that do not cast.

    One aggregation pass over ``df`` (partial aggregation, no shuffle of rows).
    """
    aggs = []
    for f in target.fields:
        if f.name in df.columns:
            bad = F.expr(f"count_if(`{f.name}` IS NOT NULL AND try_cast(`{f.name}` AS {f.dataType.simpleString()}) IS NULL)")
        else:
            bad = F.lit(None).cast("bigint")
        aggs.append(bad.alias(f.name))
    counts = df.agg(*aggs)
    stack = ", ".join(
        f"'{f.name}', {'true' if f.name in df.columns else 'false'}, '{f.dataType.simpleString()}', `{f.name}`"
        for f in target.fields
    )
    return counts.select(
        F.expr(f"stack({len(target.fields)}, {stack}) AS (column_name, present, target_type, bad_values)")
    )


def align_to(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``select(colnames(other))`` (C11)."""
    return df.select([c(n) for n in columns])


def add_missing_columns(df: DataFrame, fields: T.StructType | Mapping[str, str]) -> DataFrame:
    """Add absent columns as typed NULLs."""
    items = [(f.name, f.dataType) for f in fields.fields] if isinstance(fields, T.StructType) else list(fields.items())
    missing = {n: F.lit(None).cast(t) for n, t in items if n not in df.columns}
    return df.withColumns(missing) if missing else df


def lower_columns(df: DataFrame, names: Iterable[str] | None = None) -> DataFrame:
    """``mutate_at(.vars, tolower)``; default: every STRING column.

    Non-text columns (dates, numbers) keep their type.
    """
    names = [n for n, t in df.dtypes if t == "string"] if names is None else list(names)
    text = {n for n, t in df.dtypes if t == "string"}
    return df.withColumns({n: F.lower(c(n)) for n in names if n in text})


def sentinel_to_null(df: DataFrame, sentinel: str = "NA", names: Iterable[str] | None = None) -> DataFrame:
    """``x[x == 'NA'] <- NA`` over text columns."""
    text = [n for n, t in df.dtypes if t == "string"]
    names = text if names is None else [n for n in names if n in text]
    return df.withColumns({n: F.when(c(n) == F.lit(sentinel), F.lit(None)).otherwise(c(n)) for n in names})


def masked_assign(df: DataFrame, name: str, mask: Column, value) -> DataFrame:
    """``x$col[mask] <- value``; a NULL mask leaves the row unchanged (C17)."""
    v = value if isinstance(value, Column) else F.lit(value)
    return df.withColumn(name, F.when(F.coalesce(mask, F.lit(False)), v).otherwise(as_col(name)))
