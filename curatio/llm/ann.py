"""Approximate nearest neighbours: an NN-descent graph built by Spark joins, searched greedily.

Equal vectors are one node, so copies neither crowd each other's neighbour
lists nor tie; a node keeps the ``KEEP`` smallest ids of its rows, which are
all that a result of that length can name.  The graph starts from neighbours
in the order of random projections.  Each round joins the neighbours of every
node, forward and (a bounded number, the best) backward, and compares those pairs of
which one is new; a pair enters a list if it beats its last entry.  Rounds end
when less than ``LEAST`` of all entries change.

Queries start at their own node and expand the best ``BEAM`` nodes until none
of them is left unexpanded; nodes that tie with the last score asked for stay in
the beam beyond that, so ties are followed to their end.  Graph, search and
ranking all use the cosine of the original components in double precision, so
near copies are told apart.  All rows are indexed; no table is collected or
broadcast by hand.

Defined results: vectors that are null, empty, zero, hold null or non-finite
components, have a null id, or not the most frequent length (of equally
frequent ones the smallest), take no part; rows that share an id are
candidates once, with the better score; with fewer candidates than asked for
all are returned; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curatio.llm.common import durable, prepare

DEGREE, BACK, BEAM, KEEP = 32, 32, 128, 6
PROJECTIONS, SPAN = 8, 5
LEAST = 0.01
EDGES = "src long, dst long, sim double"


def pack(kind: str):
    """UDF: arrays of numbers to packed components of type ``kind``, which holds them exactly."""

    def run(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in it:
            yield pd.Series([np.asarray(v, dtype=np.float64).astype(kind).tobytes() for v in s], dtype=object)

    run.__annotations__ = {"it": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "binary")


def matrix(col: pd.Series, kind: str) -> np.ndarray:
    """Unit vectors of packed components."""
    x = np.frombuffer(b"".join(map(bytes, col)), dtype=kind).reshape(len(col), -1).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def usable(v: Column) -> Column:
    """Non-empty, all components finite, at least one of them not 0."""
    ok = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    return F.coalesce((F.size(v) > 0) & F.forall(v, ok) & F.exists(v, lambda x: x != 0), F.lit(False))


def beside(kind: str):
    """mapInPandas over vectors sorted along a projection: links to the next few."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in it:
            x, ids = matrix(f["z"], kind), f["node"].to_numpy()
            out = []
            for k in range(1, min(SPAN, len(f) - 1) + 1):
                sim = (x[k:] * x[:-k]).sum(axis=1)
                out += [pd.DataFrame({"src": ids[k:], "dst": ids[:-k], "sim": sim}), pd.DataFrame({"src": ids[:-k], "dst": ids[k:], "sim": sim})]
            if out:
                yield pd.concat(out)

    return run


def projected(p: int, dim: int, kind: str):
    def run(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
        line = np.random.default_rng(100 + p).standard_normal(dim)
        for s in it:
            yield pd.Series(matrix(s, kind) @ line)

    run.__annotations__ = {"it": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "double")


def best(edges: DataFrame, key: str, other: str, most: int) -> DataFrame:
    """The ``most`` best entries of each key; limits inside the tasks come before the shuffle."""
    w = Window.partitionBy(key).orderBy(F.col("sim").desc(), F.col(other))
    return edges.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= most).drop("__r")


def compare(kind: str):
    """mapInPandas over rows (v, u, z, last, new) sorted by v: pairs of a node's neighbours that improve a list."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for f in it:
            rest = f if rest is None else pd.concat([rest, f], ignore_index=True)
            v = rest["v"].to_numpy()
            cut = int(np.searchsorted(v, v[-1]))  # the last node's rows may go on
            if cut:
                yield improved(rest.iloc[:cut], kind)
                rest = rest.iloc[cut:].reset_index(drop=True)
        if rest is not None and len(rest):
            yield improved(rest, kind)

    return run


def improved(f: pd.DataFrame, kind: str) -> pd.DataFrame:
    x, u, last, new = matrix(f["z"], kind), f["u"].to_numpy(), f["last"].to_numpy(), f["new"].to_numpy()
    edge = np.flatnonzero(np.diff(f["v"].to_numpy())) + 1
    src, dst, sims = [], [], []
    for a, b in zip(np.concatenate(([0], edge)), np.concatenate((edge, [len(f)]))):
        s = x[a:b] @ x[a:b].T
        ok = new[a:b, None] | new[None, a:b]
        i, j = np.nonzero(ok & (s > last[a:b, None]) & (u[a:b, None] != u[None, a:b]))
        src.append(u[a:b][i])
        dst.append(u[a:b][j])
        sims.append(s[i, j])
    return pd.DataFrame({"src": np.concatenate(src), "dst": np.concatenate(dst), "sim": np.concatenate(sims)}).drop_duplicates(["src", "dst"])


def graph(nodes: DataFrame, dim: int, kind: str) -> DataFrame:
    """(node, z) -> (src, dst, sim): up to ``DEGREE`` near neighbours of each node."""
    start = None
    for p in range(PROJECTIONS):
        near = nodes.withColumn("at", projected(p, dim, kind)("z")).repartitionByRange("at").sortWithinPartitions("at", "node")
        near = near.select("node", "z").mapInPandas(beside(kind), EDGES)
        start = near if start is None else start.union(near)
    edges = durable(best(start.distinct(), "src", "dst", DEGREE).withColumn("new", F.lit(True)))
    total = max(1, edges.count())
    while True:
        last = edges.groupBy("src").agg(F.min("sim").alias("last"), F.count(F.lit(1)).alias("n"))
        last = last.select(F.col("src").alias("u"), F.when(F.col("n") < DEGREE, F.lit(-2.0)).otherwise(F.col("last")).cast("double").alias("last"))
        side = durable(nodes.select(F.col("node").alias("u"), "z").join(last, "u"))
        back = best(edges, "dst", "src", BACK).select(F.col("dst").alias("v"), F.col("src").alias("u"), "new")
        around = edges.select(F.col("src").alias("v"), F.col("dst").alias("u"), "new").union(back)
        around = around.groupBy("v", "u").agg(F.max("new").alias("new"))
        fresh = around.groupBy("v").agg(F.max("new").alias("any")).where("any").select("v")
        around = around.join(fresh, "v", "left_semi").join(side, "u").select("v", "u", "z", "last", "new")
        found = around.repartition("v").sortWithinPartitions("v").mapInPandas(compare(kind), EDGES)
        every = edges.select("src", "dst", "sim", F.lit(False).alias("new")).union(found.select("*", F.lit(True).alias("new")))
        every = every.groupBy("src", "dst").agg(F.max("sim").alias("sim"), F.min("new").alias("new"))
        edges = durable(best(every, "src", "dst", DEGREE))
        if edges.where("new").count() < LEAST * total:
            return edges.select("src", "dst", "sim")


def cosine(kind: str):
    """UDF: cosine of two packed vectors."""

    def run(it: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for a, b in it:
            yield pd.Series((matrix(a, kind) * matrix(b, kind)).sum(axis=1))

    run.__annotations__ = {"it": Iterator[tuple[pd.Series, pd.Series]], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "double")


def search(starts: DataFrame, nodes: DataFrame, edges: DataFrame, most: int, kind: str) -> DataFrame:
    """(q) nodes that are queried -> (q, node): the beam of each after greedy expansion."""
    back = best(edges, "dst", "src", BACK).select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    links = durable(edges.select("src", "dst").union(back).distinct())
    score = cosine(kind)
    order = Window.partitionBy("q").orderBy(F.col("sim").desc(), "node")
    level = Window.partitionBy("q").orderBy(F.col("sim").desc())
    qz = nodes.select(F.col("node").alias("q"), F.col("z").alias("qz"))
    nz = nodes.select("node", "z")
    beam = durable(starts.select("q", F.col("q").alias("node"), F.lit(2.0).alias("sim"), F.lit(False).alias("done")))
    while True:
        open_ = beam.where("NOT done").select("q", F.col("node").alias("src"))
        if open_.isEmpty():
            return beam.select("q", "node")
        seen = open_.join(links, "src").select("q", F.col("dst").alias("node")).distinct()
        seen = seen.join(beam.select("q", "node"), ["q", "node"], "left_anti")
        met = seen.join(nz, "node").join(qz, "q").select("q", "node", score("qz", "z").alias("sim"), F.lit(False).alias("done"))
        every = beam.select("q", "node", "sim", F.lit(True).alias("done")).union(met)
        # the query's own node is among them; rank() counts ties at the last score asked for as one
        every = every.withColumn("r", F.row_number().over(order)).withColumn("tie", F.rank().over(level))
        beam = durable(every.where((F.col("r") <= BEAM) | (F.col("tie") <= most + 1)).drop("r", "tie"))


def neighbours(table: DataFrame, queries: Column, *, vec_id: str = "vec_id", vector: str = "embedding", most: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the ``most`` nearest found of each query row, nearest first.

    ``queries``: condition on the rows of ``table`` that are queried.
    """
    if most >= KEEP:
        raise ValueError(f"a node keeps {KEEP} ids, which is enough for fewer than {KEEP} neighbours")
    spark = table.sparkSession
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")
    t = table.select(F.col(vec_id).alias("id"), F.col(vector).alias("v"), F.coalesce(queries, F.lit(False)).alias("asked"))
    t = t.where(F.col("id").isNotNull() & usable(F.col("v"))).withColumn("dim", F.size("v"))
    dims = t.groupBy("dim").agg(F.count(F.lit(1)).alias("n"))
    dim = dims.orderBy(F.col("n").desc(), "dim").first()
    dim = dim[0] if dim else 1
    kind = "<f4" if t.schema["v"].dataType.elementType.typeName() == "float" else "<f8"
    t = durable(t.where(F.col("dim") == dim).select("id", "asked", pack(kind)("v").alias("x")))
    w = Window.partitionBy("x").orderBy("id")
    few = t.select("id", "x").distinct().withColumn("r", F.row_number().over(w)).where(F.col("r") <= KEEP)
    nodes = durable(few.groupBy("x").agg(F.min("id").alias("node"), F.collect_list("id").alias("ids")))
    # an id under several vectors could stand for several nodes: the vector tells them apart
    nodes = durable(nodes.withColumn("node", F.xxhash64("x", "node")))
    asked = durable(t.where("asked").select(F.col("id").alias("query_id"), "x").distinct().join(nodes.select("x", F.col("node").alias("q")), "x").select("query_id", "q"))
    packed = nodes.select("node", F.col("x").alias("z"))
    edges = graph(packed, dim, kind)
    beam = search(asked.select("q").distinct(), packed, edges, most, kind)
    exact = cosine(kind)
    side = nodes.select("node", "x", "ids")
    met = beam.join(side, "node").join(nodes.select(F.col("node").alias("q"), F.col("x").alias("qx")), "q")
    met = met.select("q", exact("qx", "x").alias("sim"), F.explode("ids").alias("vec_id"))
    # one more than asked for, as the query's own row is among them
    met = met.groupBy("q", "vec_id").agg(F.max("sim").alias("sim"))
    met = best(met, "q", "vec_id", most + 1).join(asked, "q").where(F.col("vec_id") != F.col("query_id"))
    met = met.groupBy("query_id", "vec_id").agg(F.max("sim").alias("sim"))
    w = Window.partitionBy("query_id").orderBy(F.col("sim").desc(), "vec_id")
    met = met.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most)
    return met.select("query_id", "rank", "vec_id", F.col("sim").alias("score"))
