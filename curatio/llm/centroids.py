"""Centroid clustering of integer vectors with Ptolemaic lower bounds.

Components become integers, floor(scale * x).  The first centroids are the
kept vectors with the smallest SHA-256 of ``<seed>:<id>``.  A round assigns all
vectors and replaces each centroid by the componentwise floor of its vectors'
mean, from exact sums: every task adds up its own vectors, and one row a task
and centroid is shuffled.

The pivots are ``PIVOTS`` of the first centroids, chosen far from each other
and fixed from then on, and all their pairs.  The distance of each vector to
each pivot is computed once and stored beside it.  For a vector o, a centroid c and a pair
(p, q) Ptolemy's inequality gives

    d(o, c) >= |d(o, p) d(c, q) - d(o, q) d(c, p)| / d(p, q)

so a centroid whose largest bound exceeds the best distance found so far is
skipped.  Bounds are rounded down by more than the products can be off by;
centroids with a bound equal to the best distance survive, so ties are seen.
Survivors are compared in order of their bounds by exact integer arithmetic.

Bounded at the driver and in every task: ``k`` centroids and their pivot
distances; the vectors stay in tasks, in Arrow batches.

Defined results: vectors that are null, have another number of components, or
hold null or non-finite ones take no part and are not in the result; a null id
hashes as the empty text and its row takes part; repeated rows take part each
(equal hashes: the smaller vector first); with fewer than ``k`` kept vectors all
of them start a centroid; centroids without vectors stay; equal distances go to
the smaller number; an empty table gives an empty result.  Components from
``LIMIT`` on stop the job with an error, because squared distances would not
fit a long.  Further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curatio.llm.common import durable, prepare

PIVOTS = 8
# 64 squares of differences of two such components stay below 2^62.
LIMIT = 1 << 27
BATCH_ROWS = "2048"
# What a product of two distances or their quotient may be off by is far less.
SLACK = 1e-12


def whole(v: Column, scale: int) -> Column:
    """Components as floor(scale * x); an error from LIMIT on."""
    def one(x: Column) -> Column:
        y = F.floor(x.cast("double") * float(scale))
        return F.when(F.abs(x.cast("double")) < LIMIT / scale, y).otherwise(F.raise_error(F.lit("component too large for exact distances")).cast("bigint"))

    return F.transform(v, one)


def kept(v: Column, dim: int) -> Column:
    """Exactly ``dim`` components, all of them finite numbers."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    return F.coalesce((F.size(v) == dim) & F.forall(v, finite), F.lit(False))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of integer vectors; the squares are exact, the root is the nearest double or its neighbour."""
    return np.stack([np.sqrt(((a - x) ** 2).sum(axis=1).astype(np.float64)) for x in b], axis=1) if len(b) else np.empty((len(a), 0))


def far_apart(x: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` different rows, each the farthest from those before it."""
    chosen, near = [0], distances(x, x[:1])[:, 0]
    while len(chosen) < most and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, distances(x, x[chosen[-1:]])[:, 0])
    return x[chosen]


class Bounds:
    """Lower bounds on the distances to ``centres`` from distances to fixed pivots."""

    def __init__(self, pivots: np.ndarray, centres: np.ndarray) -> None:
        between, self.centre = distances(pivots, pivots), distances(centres, pivots)
        self.pairs = [(i, j, 1.0 / between[i, j]) for i, j in combinations(range(len(pivots)), 2)]

    def lower(self, near: np.ndarray) -> np.ndarray:
        """(vectors, centres) from the vectors' pivot distances ``near``; 0 where no pair says more."""
        low = np.zeros((len(near), len(self.centre)))
        for i, j, w in self.pairs:
            a, b = near[:, i, None] * self.centre[None, :, j], near[:, j, None] * self.centre[None, :, i]
            np.maximum(low, (np.abs(a - b) - SLACK * (a + b)) * w, out=low)
        return low * (1 - SLACK)


def nearest(x: np.ndarray, centres: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance of each vector's nearest centre, and how many distances were computed."""
    order = np.argsort(low, axis=1, kind="stable")
    best, number, rows, computed = np.full(len(x), np.iinfo(np.int64).max), np.zeros(len(x), dtype=np.int64), np.arange(len(x)), 0
    for r in range(len(centres)):
        c = order[rows, r]
        # bounds ascend along the row, so a vector that is done stays done
        on = low[rows, c] ** 2 * (1 - SLACK) <= best[rows]
        rows, c = rows[on], c[on]
        if not len(rows):
            break
        d = ((x[rows] - centres[c]) ** 2).sum(axis=1)
        computed += len(rows)
        better = (d < best[rows]) | ((d == best[rows]) & (c < number[rows]))
        best[rows[better]], number[rows[better]] = d[better], c[better]
    return number, best, computed


def rows_of(col: pd.Series, dim: int, kind: type) -> np.ndarray:
    return np.array(col.tolist(), dtype=kind).reshape(len(col), dim)


def assign(dim: int, pivots: np.ndarray, centres: np.ndarray):
    """A function of a batch's vectors and pivot distances: (number, squared distance) of each."""
    bounds = Bounds(pivots, centres)
    return lambda f: nearest(rows_of(f["v"], dim, np.int64), centres, bounds.lower(rows_of(f["near"], len(pivots), np.float64)))


def sums(dim: int, pivots: np.ndarray, centres: np.ndarray):
    """mapInPandas: count and componentwise sum of a task's vectors by centre."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of, total, n = assign(dim, pivots, centres), np.zeros((len(centres), dim), dtype=np.int64), np.zeros(len(centres), dtype=np.int64)
        for f in it:
            number, _, _ = of(f)
            np.add.at(total, number, rows_of(f["v"], dim, np.int64))
            n += np.bincount(number, minlength=len(centres))
        some = np.flatnonzero(n)
        yield pd.DataFrame({"cluster": some, "n": n[some], "s": list(total[some])})

    return run


def labelled(dim: int, pivots: np.ndarray, centres: np.ndarray):
    """mapInPandas: vec_id, cluster, distance and how many distances were computed for the batch's first row."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of = assign(dim, pivots, centres)
        for f in it:
            number, best, computed = of(f)
            f["cluster"], f["distance"] = number, best
            f["computed"] = np.where(np.arange(len(f)) == 0, computed, 0)
            yield f[["vec_id", "cluster", "distance", "computed"]]

    return run


def updated(t: DataFrame, dim: int, pivots: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The centres after one round; at most one row a centre reaches the driver."""
    part = t.mapInPandas(sums(dim, pivots, centres), "cluster int, n bigint, s array<bigint>")
    found = part.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("s")[j]) for j in range(dim)]).alias("s")).collect()
    out = centres.copy()
    for r in found:
        out[r["cluster"]] = [s // r["n"] for s in r["s"]]
    return out


def cluster(
    table: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", dim: int = 64, scale: int = 256, k: int = 40,
    rounds: int = 5, seed: str = "2",
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 and computed for every kept vector.

    ``computed`` counts the exact distances of the last assignment (a batch's
    on its first row); without bounds its sum would be rows times ``k``.
    """
    spark = table.sparkSession
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    id_type = table.schema[vec_id].dataType.simpleString()
    t = table.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("v")).where(kept(F.col("v"), dim))
    t = t.select("vec_id", whole(F.col("v"), scale).alias("v"))
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    first = t.select(name.alias("h"), "v").orderBy("h", "v").limit(k).collect()
    centres = np.array([r["v"] for r in first], dtype=np.int64).reshape(len(first), dim)
    columns = f"vec_id {id_type}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string, computed bigint"
    if not len(first):
        return spark.createDataFrame([], columns)
    pivots = far_apart(centres, PIVOTS)

    def near(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in it:
            yield pd.Series(list(distances(rows_of(s, dim, np.int64), pivots)))

    near.__annotations__ = {"it": Iterator[pd.Series], "return": Iterator[pd.Series]}
    t = durable(t.withColumn("near", F.pandas_udf(near, T.ArrayType(T.DoubleType()))("v")))
    for _ in range(rounds):
        centres = updated(t, dim, pivots, centres)
    out = durable(t.mapInPandas(labelled(dim, pivots, centres), f"vec_id {id_type}, cluster int, distance bigint, computed bigint"))
    # at most k rows
    inertia = {r["cluster"]: r["i"] for r in out.groupBy("cluster").agg(F.sum("distance").alias("i")).collect()}
    digest = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centres]
    of = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("cluster") + 1)
    return out.select(
        "vec_id", "cluster", "distance", of([inertia.get(c, 0) for c in range(len(centres))]).cast("bigint").alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("bigint").alias("inertia"), of(digest).alias("centroid_sha256"), "computed",
    )
