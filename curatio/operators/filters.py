"""Row filters with R's NA semantics made explicit."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatio.functions.expr import as_col, empty_or_null, in_values, not_in_values
from curatio.functions.rules import SHARE_ALL, START_DATE


def since(df: DataFrame, ts_col: str, start: str = START_DATE) -> DataFrame:
    """Keep rows whose timestamp falls on or after ``start``.

    ``as.Date(ts) >= start`` equals ``ts >= start 00:00`` in UTC; the second
    form compares the raw column with a literal, so Parquet row-group
    statistics and partition pruning apply.  NULL timestamps are dropped.
    """
    col = as_col(ts_col)
    if dict(df.dtypes).get(ts_col) == "date":
        return df.where(col >= F.to_date(F.lit(start)))
    return df.where(col >= F.lit(start).cast(dict(df.dtypes).get(ts_col, "timestamp")))


def consented(df: DataFrame, scope_col: str = "userSharingScope", value: str = SHARE_ALL) -> DataFrame:
    """Keep rows shared with all qualified researchers (D6); NULL scope dropped."""
    return df.where(as_col(scope_col) == F.lit(value))


def member_of(df: DataFrame, col: str, values: Iterable) -> DataFrame:
    """``filter(x %in% values)``."""
    return df.where(in_values(col, values))


def not_member_of(df: DataFrame, col: str, values: Iterable) -> DataFrame:
    """``filter(!x %in% values)``: NULL ``x`` is kept."""
    return df.where(not_in_values(col, values))


def not_null(df: DataFrame, *cols: str) -> DataFrame:
    """``x[!is.na(x$c), ]``."""
    cond = None
    for n in cols:
        e = as_col(n).isNotNull()
        cond = e if cond is None else cond & e
    return df.where(cond) if cond is not None else df


def true_flag(df: DataFrame, col: str) -> DataFrame:
    """``filter(value == TRUE)``; NULL dropped."""
    return df.where(as_col(col) == F.lit(True))


def complete_cases(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """``na.omit``."""
    return df.dropna(how="any", subset=list(cols) if cols is not None else None)


def empty_or_null_rows(df: DataFrame, col: str) -> DataFrame:
    """Rows whose value is NULL or empty text."""
    return df.where(empty_or_null(col))


def having(df: DataFrame, cond: Column) -> DataFrame:
    """Filter on an aggregate result."""
    return df.where(cond)
