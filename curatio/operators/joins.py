"""Equi-joins with R's NA-matching rules.

R's ``%in%`` and ``merge`` treat NA as a matchable value; SQL equality does
not.  Every join here uses ``<=>`` (``eqNullSafe``), which Spark still plans
as a hash join (it hashes the coalesced key plus an is-null bit).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatio.functions.expr import c

# No side is broadcast by hand: Spark broadcasts one only when its size estimate
# is below ``spark.sql.autoBroadcastJoinThreshold``, and AQE re-plans a shuffle
# join when the measured output of a side is small.


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _side(lst: DataFrame, list_keys: list[str], ignore_case: bool = False) -> DataFrame:
    fold = F.lower if ignore_case else lambda x: x
    return lst.select([fold(c(lk)).alias(f"__k{i}") for i, lk in enumerate(list_keys)])


def _cond(df: DataFrame, side: DataFrame, keys: list[str], ignore_case: bool = False):
    fold = F.lower if ignore_case else lambda x: x
    cond = None
    for i, k in enumerate(keys):
        e = fold(df[f"`{k}`"]).eqNullSafe(side[f"__k{i}"])
        cond = e if cond is None else cond & e
    return cond


def exclude(
    df: DataFrame,
    lst: DataFrame,
    key: str | Sequence[str],
    list_key: str | Sequence[str] | None = None,
    ignore_case: bool = False,
) -> DataFrame:
    """``filter(!key %in% lst$key)`` as a null-safe anti join.

    A NULL key survives unless the list itself holds a NULL.  ``ignore_case``
    compares lower-cased keys (participant ids typed by hand).
    """
    keys = _keys(key)
    side = _side(lst, _keys(list_key) if list_key else keys, ignore_case)
    return df.join(side, _cond(df, side, keys, ignore_case), "left_anti")


def retain(
    df: DataFrame,
    lst: DataFrame,
    key: str | Sequence[str],
    list_key: str | Sequence[str] | None = None,
    ignore_case: bool = False,
) -> DataFrame:
    """``filter(key %in% lst$key)`` as a null-safe semi join."""
    keys = _keys(key)
    side = _side(lst, _keys(list_key) if list_key else keys, ignore_case)
    return df.join(side, _cond(df, side, keys, ignore_case), "left_semi")


def mark_member(
    df: DataFrame,
    lst: DataFrame,
    key: str,
    flag: str,
    list_key: str | None = None,
    ignore_case: bool = False,
) -> DataFrame:
    """``flag = key %in% lst$key`` — never NULL.

    The list is reduced to distinct keys first so the left join cannot fan out.
    """
    side = _side(lst, [list_key or key], ignore_case).distinct().withColumn("__hit", F.lit(True))
    out = df.join(side, _cond(df, side, [key], ignore_case), "left")
    return out.withColumn(flag, F.coalesce(F.col("__hit"), F.lit(False))).drop("__k0", "__hit")


def left_lookup(
    df: DataFrame,
    dim: DataFrame,
    key: str | Sequence[str],
    dim_key: str | Sequence[str] | None = None,
) -> DataFrame:
    """``merge(x, dim, all.x = TRUE)`` on null-safe keys.

    Left rows without a match keep NULLs; a key with several dimension rows
    fans out, as in R.  Only the left key columns are kept.
    """
    keys = _keys(key)
    dkeys = _keys(dim_key) if dim_key else keys
    ren = {dk: f"__k{i}" for i, dk in enumerate(dkeys)}
    side = dim.withColumnsRenamed(ren)
    out = df.join(side, _cond(df, side, keys), "left")
    return out.drop(*ren.values())


def inner_lookup(
    df: DataFrame,
    dim: DataFrame,
    key: str | Sequence[str],
    dim_key: str | Sequence[str] | None = None,
) -> DataFrame:
    """``inner_join`` / ``merge(x, y)`` on null-safe keys."""
    keys = _keys(key)
    dkeys = _keys(dim_key) if dim_key else keys
    ren = {dk: f"__k{i}" for i, dk in enumerate(dkeys)}
    side = dim.withColumnsRenamed(ren)
    return df.join(side, _cond(df, side, keys), "inner").drop(*ren.values())


def same_keys(a: DataFrame, b: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """``a`` and ``b`` joined on keys of the same names, null-safe; the keys stand once."""
    r = b.withColumnsRenamed({k: f"__r{i}" for i, k in enumerate(keys)})
    cond = reduce(lambda x, y: x & y, [a[f"`{k}`"].eqNullSafe(r[f"__r{i}"]) for i, k in enumerate(keys)])
    return a.join(r, cond, how).drop(*[f"__r{i}" for i in range(len(keys))])


def natural_keys(a: DataFrame, b: DataFrame) -> list[str]:
    """Shared column names — the key set of R's ``merge`` without ``by``."""
    return [n for n in a.columns if n in set(b.columns)]


def full_outer_coalesced(a: DataFrame, b: DataFrame, key: str | Sequence[str] | None = None) -> DataFrame:
    """``merge(a, b, all = TRUE)``: full outer on null-safe keys, keys coalesced.

    Both sides are large participant summaries, so this is a shuffle
    (sort-merge) join on the key; no broadcast.
    """
    keys = _keys(key) if key else natural_keys(a, b)
    la = a.withColumnsRenamed({k: f"__a{i}" for i, k in enumerate(keys)})
    rb = b.withColumnsRenamed({k: f"__b{i}" for i, k in enumerate(keys)})
    cond = None
    for i, _ in enumerate(keys):
        e = la[f"__a{i}"].eqNullSafe(rb[f"__b{i}"])
        cond = e if cond is None else cond & e
    j = la.join(rb, cond, "full_outer")
    key_cols = [F.coalesce(F.col(f"__a{i}"), F.col(f"__b{i}")).alias(k) for i, k in enumerate(keys)]
    rest = [c(n) for n in j.columns if not n.startswith("__a") and not n.startswith("__b")]
    return j.select(*key_cols, *rest)
