"""Wide/long reshaping and the per-participant summaries built on it."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatio.functions.expr import c
from curatio.operators.aggregates import _order_struct, join_parts, latest_nonnull, ordered_parts
from curatio.operators.joins import same_keys
from curatio.session import written


def unpivot(
    df: DataFrame, ids: Sequence[str], cols: Sequence[str] | None, name: str, value: str, as_text: bool = False,
    in_place: bool = False,
) -> DataFrame:
    """``gather``: wide to long (G1, G2).  ``cols=None`` means all but ``ids``.

    With ``as_text`` every value is cast to STRING first (R's gather of mixed
    types), numbers printed without a trailing ``.0``.  ``in_place``: for columns
    of one type; the long rows keep the partitioning of ``df``, which Spark's
    ``unpivot`` gives up, so windows by its keys and ``name`` need no shuffle.
    """
    cols = [n for n in df.columns if n not in set(ids)] if cols is None else list(cols)
    if as_text:
        types = dict(df.dtypes)
        conv = {}
        for n in cols:
            if types[n] in ("double", "float"):
                conv[n] = F.regexp_replace(c(n).cast("string"), r"\.0$", "")
            elif types[n] != "string":
                conv[n] = c(n).cast("string")
        if conv:
            df = df.withColumns(conv)
    if in_place:
        cells = F.explode(F.array(*[F.struct(F.lit(n).alias("k"), c(n).alias("v")) for n in cols])).alias("__cell")
        keys = [c(i) for i in ids]
        return df.select(*keys, cells).select(*keys, F.col("__cell.k").alias(name), F.col("__cell.v").alias(value))
    tmp = {n: f"__u{i}" for i, n in enumerate(cols)}
    renamed = df.select(*[c(i) for i in ids], *[c(n).alias(tmp[n]) for n in cols])
    long = renamed.unpivot([c(i) for i in ids], list(tmp.values()), name, value)
    mapping = F.create_map(*[x for n in cols for x in (F.lit(tmp[n]), F.lit(n))])
    return long.withColumn(name, mapping[F.col(name)])


def pivot(df: DataFrame, ids: Sequence[str], key: str, value: str, keys: Sequence[str]) -> DataFrame:
    """``spread``: long to wide with an explicit key list.

    Passing the list avoids the extra job Spark runs to discover the keys.
    Each (id, key) holds at most one value in the reference's use; ``max``
    makes the choice deterministic if it ever holds more.
    """
    return df.groupBy(*[c(i) for i in ids]).pivot(key, list(keys)).agg(F.max(c(value)))


def flags_to_list(df: DataFrame, key: str, flag_cols: Sequence[str], strip: str, out: str) -> DataFrame:
    """One-hot TRUE flags -> comma list of flag names per key, in column order.

    Equivalent to gather -> filter(value) -> strip prefix -> paste(unique),
    but as one partially-aggregated ``groupBy`` with ``bool_or`` per flag.
    Keys without any TRUE flag are absent (the reference inner-joins them away).
    """
    labels = [re.sub(strip, "", n) for n in flag_cols]
    hits = [F.when(F.bool_or(c(n) == F.lit(True)), F.lit(lbl)) for n, lbl in zip(flag_cols, labels)]
    agg = df.groupBy(c(key)).agg(F.concat_ws(",", *hits).alias(out))
    return agg.where(F.col(out) != F.lit(""))


def latest_profile(
    df: DataFrame, key: str, order: Sequence[str | Column], features: Sequence[str]
) -> DataFrame:
    """Per key, the last non-NULL value of every feature.

    Replaces gather -> group -> spread with one ``groupBy`` of ``max_by``.
    """
    return df.groupBy(c(key)).agg(*[latest_nonnull(f, order).alias(f) for f in features])


def change_report(
    df: DataFrame,
    key: str,
    order: Sequence[str | Column],
    features: Sequence[str],
    date_col: str | None = None,
) -> DataFrame:
    """QC report per (key, feature): distinct count, ordered distinct list, latest value.

    Rows: ``key, feature, n_uniq_values, unique_values, value``.  The first
    aggregation is by (key, feature, value); the distinct values of a hot key
    become list parts in many tasks (``ordered_parts``) before they are one text.
    """
    ids = [key] + ([date_col] if date_col else [])
    o = _order_struct(order)
    base = df.select(*[c(i) for i in dict.fromkeys(ids)], o.alias("__o"), *[c(f) for f in features])
    long = unpivot(base, [*dict.fromkeys(ids), "__o"], features, "feature", "value", as_text=True)
    per_value = long.groupBy(c(key), "feature", "value").agg(
        F.min("__o").alias("__first"), F.max("__o").alias("__last")
    )
    # used twice, so written once
    per_value = written(per_value, "values")
    lists = per_value.where(F.col("value").isNotNull()).select(c(key), "feature", F.col("value").alias("__v"), F.col("__first").alias("__o"))
    lists = join_parts(ordered_parts(lists, [key, "feature"], "unique_values"), [key, "feature"], "unique_values")
    rest = per_value.groupBy(c(key), "feature").agg(
        F.count("value").alias("n_uniq_values"),
        F.max_by("value", F.when(F.col("value").isNotNull(), F.col("__last"))).alias("value"),
    )
    out = same_keys(rest, lists, [key, "feature"])
    return out.select(c(key), "feature", "n_uniq_values", F.coalesce("unique_values", F.lit("")).alias("unique_values"), "value")


def map_to_rows(df: DataFrame, map_col: str, id_col: str, value_col: str, keep: Sequence[str] = ()) -> DataFrame:
    """Named list -> rows with an id column (``rbindlist(idcol=)``, G7)."""
    return df.select(*[c(k) for k in keep], F.explode(c(map_col)).alias(id_col, value_col))
