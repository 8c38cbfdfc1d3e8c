"""Aggregates with explicit order and NA rules.

Every operator here is a ``groupBy`` with partially-aggregated functions
(``max_by``/``min_by``/``count``/``sum``), so a key that holds a large share
of the rows is combined map-side before the shuffle; no operator collects a
whole group's rows into one task.  An ordered string list is put together
from parts of bounded size; only where one string per key is asked for do a key's
parts meet, which is the size of the result itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatio.functions.expr import as_col, c
from curatio.operators.segmented import segmented


def _order_struct(order: Sequence[str | Column]) -> Column:
    cols = [as_col(o) for o in order]
    return cols[0] if len(cols) == 1 else F.struct(*cols)


def latest_nonnull(value: str | Column, order: Sequence[str | Column]) -> Column:
    """Value at the greatest ``order`` among rows where value is not NULL.

    NULL when every value is NULL.  ``order`` must be unique within a group
    (add a row id as the last element) for a deterministic result.
    """
    v = as_col(value)
    return F.max_by(v, F.when(v.isNotNull(), _order_struct(order)))


def last_in_order(value: str | Column, order: Sequence[str | Column]) -> Column:
    """Value of the last row after sorting by ``order``."""
    return F.max_by(as_col(value), _order_struct(order))


def first_in_order(value: str | Column, order: Sequence[str | Column]) -> Column:
    """Value of the first row in ``order``."""
    return F.min_by(as_col(value), _order_struct(order))


def strict(agg: Column, *inputs: str | Column) -> Column:
    """R's default ``na.rm = FALSE``: NULL if any input of the group is NULL."""
    ok = None
    for i in inputs:
        e = F.count(as_col(i)) == F.count(F.lit(1))
        ok = e if ok is None else ok & e
    return F.when(ok, agg)


def sum_or_zero(col: str | Column) -> Column:
    """``sum(x, na.rm = TRUE)``: 0 for a group without values."""
    return F.coalesce(F.sum(as_col(col)), F.lit(0).cast("double"))


def count_distinct_nonnull(col: str | Column) -> Column:
    """``length(unique(na.omit(x)))``."""
    return F.count_distinct(as_col(col))


def ordered_distinct_concat(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    order: Sequence[str | Column],
    out: str,
    sep: str = ",",
) -> DataFrame:
    """``paste(unique(na.omit(v)), collapse = sep)`` in first-appearance order.

    (key, value) -> first position is a partial aggregation; the rest is
    ``ordered_parts`` and ``join_parts``.  Keys with only NULL values have no row.
    """
    firsts = first_appearance(df, keys, value, order)
    return join_parts(ordered_parts(firsts, keys, out, sep), keys, out, sep)


def first_appearance(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str | Column]) -> DataFrame:
    """Rows ``(keys..., __v, __o)``: each distinct non-NULL value of a key and its first position."""
    return (
        df.where(c(value).isNotNull())
        .groupBy(*[c(k) for k in keys], c(value).alias("__v"))
        .agg(F.min(_order_struct(order)).alias("__o"))
    )


def ordered_parts(firsts: DataFrame, keys: Sequence[str], out: str, sep: str = ",", size: int = 4096,
                  rows: int | None = None) -> DataFrame:
    """Rows ``(keys..., part, out)``: the values ``__v`` in the order of ``__o``, ``size`` of them a part.

    Positions come from the segmented series, so that a key with most of all
    values is spread over tasks by rows, and a task never holds more than a part.
    """
    at = segmented(firsts.select(*[c(k) for k in keys], "__o", "__v"), keys, ["__o", "__v"], rows=rows, position="__p")
    text = F.transform(F.array_sort(F.collect_list(F.struct("__p", "__v"))), lambda x: x["__v"].cast("string"))
    return at.groupBy(*[c(k) for k in keys], F.floor(F.col("__p") / F.lit(size)).alias("part")).agg(F.array_join(text, sep).alias(out))


def join_parts(parts: DataFrame, keys: Sequence[str], out: str, sep: str = ",") -> DataFrame:
    """One string a key from its parts."""
    text = F.transform(F.array_sort(F.collect_list(F.struct("part", c(out).alias("t")))), lambda x: x["t"])
    return parts.groupBy(*[c(k) for k in keys]).agg(F.array_join(text, sep).alias(out))


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """``distinct(keys..., .keep_all = TRUE)`` keeping the first row in ``order``.

    Implemented as ``min_by(struct(all columns), order)`` per key: a partial
    aggregate, so a hot key is reduced map-side instead of being sorted in a
    single window task.  NULL keys form their own group, as in R.
    """
    cols = df.columns
    packed = df.withColumn("__row", F.struct(*[c(n) for n in cols]))
    ordered = packed.withColumn("__ord", _order_struct(order))
    agg = ordered.groupBy(*[c(k).alias(f"__g{i}") for i, k in enumerate(keys)]).agg(
        F.min_by("__row", "__ord").alias("__row")
    )
    return agg.select([F.col("__row")[n].alias(n) for n in cols])


def distinct_rows(df: DataFrame) -> DataFrame:
    """``unique()`` over whole rows."""
    return df.distinct()


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """``unique(x$col)`` as a one-column frame (F16)."""
    return df.select(c(col)).distinct()
