"""Skew-safe ordered-series primitives: positions, lags/leads, running sums, means.

A plain ``Window.partitionBy(record)`` puts a whole recording into one task;
a recording that holds a large share of the data would then be processed
by a single core.  Here a series is cut into *chunks* by row count:

0. all samples are range-partitioned by record and all order columns and
   written once (``spread``): partitions hold like numbers of rows, however
   they are shared out among records and however many have the same leading order
   value.  A chunk is what one partition holds of a record;
1. every window function runs per (record, chunk) - one exchange + sort,
   spread over all chunks of a long recording;
2. a small per-chunk summary table (one row per chunk: row count, column
   sums) gives, through windows over the chunks of a record, each chunk's
   global row offset, running-sum offsets and the record's totals/means;
3. the at most ``K`` rows before and ``L`` rows after each chunk (the
   "halo") are looked up by global position from the chunks' boundary rows,
   so lags/leads that cross a chunk edge are exact even when chunks hold
   fewer rows than the lag;
4. summary and halo are joined back on (record, chunk) - the partitioning
   the window already produced, so the large side is not shuffled again.

Results equal those of the plain per-record window for any cut; ``rows``, the
rows a chunk should hold, only controls parallelism (by default it follows
from Spark's shuffle settings).  ``bounded=True`` is for series whose length is
bounded, by construction, such as fixed windows, or by count (``by_length``): a
plain window per record.

The write runs when the function is called, so a series is evaluated twice (range
sampling, write) however many results it feeds, and its plan ends there.

Record and chunk travel as one struct column, ``__key``: a struct is never
NULL itself and its fields compare null-safely, so rows with a NULL record key
or a NULL order value (first in the order) meet their summary in a plain
equi-join on the window's partitioning.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curatio.functions.expr import as_col
from curatio.operators.joins import exclude, retain
from curatio.session import written

# Samples up to which a record is one window of one task; longer ones are cut into chunks.
LONG_RECORD = 1 << 16


def by_length(df: DataFrame, keys: Sequence[str], apply: Callable[[DataFrame, bool], DataFrame],
              rows: int = LONG_RECORD) -> DataFrame:
    """``apply(part, bounded)`` to the records of at most ``rows`` samples (bounded) and to the longer ones, united.

    ``apply`` works record by record.  Records are counted first, on their keys alone; where
    none is long, as usual, all take one shuffle by record instead of the spread.
    """
    n = df.groupBy(*[as_col(k) for k in keys]).agg(F.count(F.lit(1)).alias("__n"))
    long = written(n.where(F.col("__n") > F.lit(rows)).drop("__n"), "long")
    if long.isEmpty():
        return apply(df, True)
    return apply(exclude(df, long, keys), True).unionByName(apply(retain(df, long, keys), False))


def spread(df: DataFrame, by: Sequence[str], rows: int | None = None) -> DataFrame:
    """``df`` range-partitioned by ``by`` and written; ``__chunk`` numbers the partitions in that order.

    A frame spread by a record's keys and order can feed several calls of
    ``segmented`` with these keys and order, which then don't write it again;
    their results keep the column for further ones.

    Rows equal in all of ``by`` stay together.  ``rows``: how many rows a
    partition should hold (counted first); by default Spark's shuffle
    partitions, joined and split by size by adaptive execution.
    """
    cols = [as_col(c) for c in by]
    if rows is None:
        d = df.repartitionByRange(*cols)
    else:
        d = df.repartitionByRange(max(1, -(-df.count() // rows)), *cols)
    return written(d.withColumn("__chunk", F.spark_partition_id().cast("bigint")), "series")


def segmented(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    rows: int | None = None,
    bounded: bool = False,
    position: str | None = None,
    length: str | None = None,
    lags: Mapping[str, Sequence[int]] | None = None,
    leads: Mapping[str, Sequence[int]] | None = None,
    running: Mapping[str, str] | None = None,
    running2: Mapping[str, str] | None = None,
    means: Mapping[str, str] | None = None,
    totals: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add series columns to ``df`` (one row per sample, ``order`` unique per record).

    * ``position``: name for the 0-based sample position within the record;
    * ``length``: name for the record's sample count;
    * ``lags`` / ``leads``: ``{column: [k, ...]}`` -> ``lag{k}_{column}`` /
      ``lead{k}_{column}``, NULL beyond the record's ends;
    * ``running``: ``{column: out}`` inclusive running sum (NULL until the first
      non-NULL value, as SQL's running ``sum``);
    * ``running2``: ``{column: out}`` running sum of the running sum,
      ``sum_{j<=k} (k - j + 1) x_j`` (NULL counted as 0; the column should
      have no NULLs), from the same pass;
    * ``means``: ``{column: out}`` record mean of the non-NULL values;
    * ``totals``: ``{column: out}`` record sum of the column.

    ``df`` is written with all its columns, unless it comes from ``spread``:
    select what is needed before.  ``rows`` and ``bounded``:
    see the module.
    """
    lags, leads = dict(lags or {}), dict(leads or {})
    running, running2, means = dict(running or {}), dict(running2 or {}), dict(means or {})
    totals = dict(totals or {})
    K = max([max(v) for v in lags.values() if v] or [0])
    L = max([max(v) for v in leads.values() if v] or [0])
    halo_cols = sorted(set(lags) | set(leads))
    kc = [as_col(k) for k in keys]
    reserved = {"__key", "__ic", "__cn", "__off", "__len", "__halo", "__bnd"}
    clash = reserved & set(df.columns)
    if clash:
        raise ValueError(f"input uses reserved column names {sorted(clash)}")
    if bounded and "__chunk" in df.columns:
        df = df.drop("__chunk")
    sums = sorted(set(running) | set(running2))
    if bounded:
        return _whole_record(df, kc, order, position, length, lags, leads, running, running2, means, totals)

    named = [k.alias(f"k{i}") for i, k in enumerate(kc)]
    d = df if "__chunk" in df.columns else spread(df, [*keys, *order], rows)
    d = d.withColumn("__key", F.struct(*named, F.col("__chunk").alias("chunk")))
    wc = Window.partitionBy("__key").orderBy(*[as_col(o) for o in order])
    wcp = Window.partitionBy("__key")
    run = wc.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.withColumn("__ic", F.row_number().over(wc) - 1).withColumn("__cn", F.count(F.lit(1)).over(wcp))
    ic = F.col("__ic")
    for col, ks in lags.items():
        for k in ks:
            d = d.withColumn(f"__wl{k}_{col}", F.lag(as_col(col), k).over(wc))
    for col, ks in leads.items():
        for k in ks:
            d = d.withColumn(f"__wd{k}_{col}", F.lead(as_col(col), k).over(wc))
    for col in sums:
        d = d.withColumn(f"__wr_{col}", F.sum(as_col(col)).over(run))
        d = d.withColumn(f"__wrn_{col}", F.count(as_col(col)).over(run))
    for col in running2:
        d = d.withColumn(f"__wq_{col}", F.sum(ic * F.coalesce(as_col(col), F.lit(0.0))).over(run))

    # one aggregation per chunk (same partitioning as the window, no exchange):
    # counts, sums, and the chunk's first L / last K rows
    aggs = [F.count(F.lit(1)).alias("__n_c")]
    for col in sums:
        aggs += [F.sum(as_col(col)).alias(f"__s_{col}"), F.count(as_col(col)).alias(f"__sn_{col}")]
    for col in running2:
        aggs += [F.sum(ic * F.coalesce(as_col(col), F.lit(0.0))).alias(f"__q_{col}")]
    for col in means:
        aggs += [F.sum(as_col(col)).alias(f"__ms_{col}"), F.count(as_col(col)).alias(f"__mn_{col}")]
    for col in totals:
        aggs += [F.sum(as_col(col)).alias(f"__ts_{col}")]
    if halo_cols and (K or L):
        edge = (ic >= F.col("__cn") - F.lit(K)) | (ic < F.lit(L))
        row = F.struct(ic.alias("ic"), *[as_col(c).alias(c) for c in halo_cols])
        aggs.append(F.collect_list(F.when(edge, row)).alias("__bnd"))
    summ = d.groupBy("__key").agg(*aggs)

    # windows over the chunks of a record (small table, one exchange)
    record = [f"__k{i}" for i in range(len(kc))]
    summ = summ.withColumns({"__at": F.col("__key.chunk"), **{r: F.col(f"__key.{r[2:]}") for r in record}})
    wr = Window.partitionBy(*record).orderBy("__at")
    before = wr.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*record)
    summ = summ.withColumn("__off", F.coalesce(F.sum("__n_c").over(before), F.lit(0)))
    summ = summ.withColumn("__len", F.sum("__n_c").over(whole))
    for col in sums:
        summ = summ.withColumn(f"__so_{col}", F.coalesce(F.sum(f"__s_{col}").over(before), F.lit(0)))
        summ = summ.withColumn(f"__son_{col}", F.coalesce(F.sum(f"__sn_{col}").over(before), F.lit(0)))
    for col in running2:
        # sum of j * x over earlier chunks, j = global position = chunk offset + in-chunk position
        jx = F.col("__off") * F.coalesce(F.col(f"__s_{col}"), F.lit(0.0)) + F.col(f"__q_{col}")
        summ = summ.withColumn(f"__jx_{col}", jx)
        summ = summ.withColumn(f"__qo_{col}", F.coalesce(F.sum(f"__jx_{col}").over(before), F.lit(0.0)))
    for col, out in means.items():
        summ = summ.withColumn(out, F.try_divide(F.sum(f"__ms_{col}").over(whole), F.sum(f"__mn_{col}").over(whole)))
    for col, out in totals.items():
        summ = summ.withColumn(out, F.sum(f"__ts_{col}").over(whole))
    info_cols = ["__off", "__len", *[f"__so_{c}" for c in sums], *[f"__son_{c}" for c in sums],
                 *[f"__qo_{c}" for c in running2], *means.values(), *totals.values()]
    if halo_cols and (K or L):
        # Halo: the K rows before a chunk lie in its K preceding non-empty
        # chunks (each holds >= 1 row) and are among their last K rows; the L
        # rows after it likewise among the first L rows of the next L chunks.
        # Boundary rows carry their global position; one map per chunk.
        glob = F.transform("__bnd", lambda r: F.struct((r["ic"] + F.col("__off")).alias("p"), r.alias("r")))
        summ = summ.withColumn("__bnd", glob)
        near = wr.rowsBetween(-K if K else 0, L if L else 0)
        summ = summ.withColumn(
            "__halo",
            F.map_from_entries(F.transform(F.flatten(F.collect_list("__bnd").over(near)),
                                           lambda e: F.struct(e["p"], e["r"]))),
        )
        info_cols.append("__halo")
    info = summ.select("__key", *info_cols)

    # back onto the rows: join on (record, chunk), the window's partitioning
    d = d.join(info, "__key", "left")
    new: dict[str, Column] = {}
    pos = F.col("__off") + ic
    for col, ks in lags.items():
        for k in ks:
            far = F.col("__halo")[pos - F.lit(k)][col]
            new[f"lag{k}_{col}"] = F.when(ic >= F.lit(k), F.col(f"__wl{k}_{col}")).otherwise(far)
    for col, ks in leads.items():
        for k in ks:
            far = F.col("__halo")[pos + F.lit(k)][col]
            new[f"lead{k}_{col}"] = F.when(ic + F.lit(k) < F.col("__cn"), F.col(f"__wd{k}_{col}")).otherwise(far)
    for col in sums:
        total = F.coalesce(F.col(f"__wr_{col}"), F.lit(0)) + F.col(f"__so_{col}")
        seen = F.col(f"__wrn_{col}") + F.col(f"__son_{col}")
        if col in running:
            new[running[col]] = F.when(seen > 0, total)
        if col in running2:
            # sum_{j<=k} (k - j + 1) x_j = (k + 1) * cumsum_k - sum_{j<=k} j x_j
            jx = F.col(f"__qo_{col}") + F.col("__off") * F.coalesce(F.col(f"__wr_{col}"), F.lit(0.0)) + F.col(f"__wq_{col}")
            new[running2[col]] = (pos + 1) * total - jx
    if position:
        new[position] = pos
    if length:
        new[length] = F.col("__len")
    d = d.withColumns(new)
    internal = reserved | {"__chunk"} | {c for c in d.columns if c.startswith(("__wl", "__wd", "__wr_", "__wrn_", "__wq_", "__so_",
                                                                  "__son_", "__qo_"))}
    keep_out = set(new) | set(means.values()) | set(totals.values())
    return d.drop(*[n for n in d.columns if n in internal and n not in keep_out and n not in df.columns])


def _whole_record(df, kc, order, position, length, lags, leads, running, running2, means, totals) -> DataFrame:
    """``bounded``: every record is one window partition (one exchange + sort)."""
    w = Window.partitionBy(*kc).orderBy(*[as_col(o) for o in order])
    part = Window.partitionBy(*kc)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    new: dict[str, Column] = {}
    for col, ks in lags.items():
        for k in ks:
            new[f"lag{k}_{col}"] = F.lag(as_col(col), k).over(w)
    for col, ks in leads.items():
        for k in ks:
            new[f"lead{k}_{col}"] = F.lead(as_col(col), k).over(w)
    for col, out in running.items():
        new[out] = F.sum(as_col(col)).over(run)
    for col, out in means.items():
        new[out] = F.avg(as_col(col)).over(part)
    for col, out in totals.items():
        new[out] = F.sum(as_col(col)).over(part)
    if position:
        new[position] = F.row_number().over(w).cast("bigint") - 1
    if length:
        new[length] = F.count(F.lit(1)).over(part)
    out = df.withColumns(new) if new else df
    if running2:
        tmp = {col: f"__r1_{col}" for col in running2}
        out = out.withColumns({t: F.sum(F.coalesce(as_col(c), F.lit(0.0))).over(run) for c, t in tmp.items()})
        out = out.withColumns({o: F.sum(F.col(tmp[c])).over(run) for c, o in running2.items()})
        out = out.drop(*tmp.values())
    return out
