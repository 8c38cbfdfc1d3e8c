"""Exact search of the largest integer inner products by a paged M-tree.

Components become integers, floor(scale * x).  With M the largest length of any
vector, each x gets one more component, sqrt(M^2 - |x|^2), and a query q a 0;
then d(q, x)^2 = |q|^2 + M^2 - 2 q.x, so the largest inner products are the
nearest vectors of a metric space, which an M-tree can index.

The root page holds up to ``ROOTS`` routing vectors, a sample by hash, and the
covering radius of what is nearest to each.  Below it a routing vector's
objects are cut by hash into subtrees of about ``TREE`` objects, each built in a
task of its own into pages: entries with their distance to the page's routing
object (the parent distance), inner pages also with covering radii and child
pages.  The pages are a written table.  Equal vectors are one object, which keeps the
``most + 1`` smallest ids of its rows, all that a result can name; so copies make
neither deep trees nor hot pages.

A search takes pages from a heap by the least distance anything in them can have,
and skips entries whose parent distance alone shows, by the triangle inequality,
that they are too far; it ends when the heap's best cannot improve the
result.  Each different query vector searches a subtree of its nearest
routing vector first.  Its score there at rank ``most + 1`` is a threshold for
the second pass, which gives each subtree the queries, in blocks of ``BLOCK``,
that the root page doesn't exclude.  Bounds are
rounded in the safe direction, ties always survive, and scores are exact integers.

Bounded: the root page (the only thing at the driver), a subtree and a block of
queries in a task.  Queries are a stated set against all rows; no row is left out.

Defined results: vectors that are null or hold null or non-finite components
take no part; missing components of shorter vectors count as 0 (an empty
vector scores 0); a null id is never a query and comes last among ties; rows that
share an id are candidates and queries each, a query excludes its own row
only; with fewer candidates all are returned; an empty table or no query gives
an empty result.  Components so large that a product may pass 2^60 raise
ValueError.  Further columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curatio.llm.common import durable, prepare

ROOTS, TREE, LEAF, FAN, BLOCK = 1024, 4096, 512, 16, 16384
# Distances are off by less than this share of the largest; scores are exact.
SLACK = 1e-7
PAGES = "seed int, part int, page int, leaf boolean, n int, z binary, up binary, radius binary, child binary, ids binary, none binary, rows binary, sizes binary"
FOUND = "e bigint, score bigint, vec_id bigint, none boolean, row bigint"


def usable(v: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    return F.coalesce(v.isNotNull() & F.forall(v, finite), F.lit(False))


def packed(dim: int):
    """UDF: arrays of integers, filled up with zeros, to their bytes."""

    def run(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in it:
            out = np.zeros((len(s), dim), dtype=np.int64)
            for x, v in zip(out, s):
                x[: len(v)] = v
            yield pd.Series([x.tobytes() for x in out], dtype=object)

    run.__annotations__ = {"it": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "binary")


class Space:
    """Products and distances of packed vectors; ``top`` is the largest squared length."""

    def __init__(self, dim: int, top: int) -> None:
        # doubles hold integers below 2^53 exactly and multiply faster
        self.dim, self.top, self.kind = dim, top, np.float64 if top < 1 << 53 else np.int64

    def rows(self, z) -> np.ndarray:
        """Packed vectors, joined or as a column, as rows of numbers."""
        raw = z if isinstance(z, bytes) else b"".join(map(bytes, z))
        n = len(raw) // (8 * self.dim) if self.dim else (0 if isinstance(z, bytes) else len(z))
        return np.frombuffer(raw, dtype=np.int64).reshape(n, self.dim).astype(self.kind)

    def distance(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Distances of vectors ``x`` from the vector ``y`` with their additional components."""
        last = lambda v: np.sqrt(np.maximum(self.top - (v * v).sum(axis=-1), 0).astype(np.float64))
        return np.sqrt(((x - y) ** 2).sum(axis=1).astype(np.float64) + (last(x) - last(y)) ** 2)

    def base(self, q: np.ndarray) -> float:
        return float((q * q).sum()) + float(self.top)

    def reach(self, base: float, dot: np.ndarray) -> np.ndarray:
        """Distance of a query from objects with these products."""
        return np.sqrt(np.maximum(base - 2.0 * dot, 0.0))


def nearest_seed(space: Space, seeds: np.ndarray):
    """UDF: (number, distance) of the nearest routing vector of the root page."""

    def run(it: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in it:
            x = space.rows(s)
            best, which = np.full(len(x), np.inf), np.zeros(len(x), dtype=np.int32)
            for k, y in enumerate(seeds):
                d = space.distance(x, y)
                which, best = np.where(d < best, k, which), np.minimum(d, best)
            yield pd.DataFrame({"seed": which, "d": best})

    run.__annotations__ = {"it": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(run, "seed int, d double")


def build(space: Space, seeds: np.ndarray, leaf: int = LEAF, fan: int = FAN):
    """applyInPandas: the objects of one subtree to its pages; page 0 is its root."""

    def run(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        seed, part = int(key[0]), int(key[1])
        f = f.sort_values("z", kind="stable")
        x, ids, none, rows = space.rows(f["z"]), f["ids"].tolist(), f["none"].tolist(), f["rows"].tolist()
        pages: list[tuple | None] = []

        def page(members: np.ndarray, routing: np.ndarray, up: np.ndarray) -> int:
            at = len(pages)
            pages.append(None)
            if len(members) <= leaf:
                flat = lambda lists, kind: np.concatenate([np.asarray(lists[m], dtype=kind) for m in members]).tobytes()
                sizes = np.array([len(ids[m]) for m in members], dtype=np.int32).tobytes()
                pages[at] = (seed, part, at, True, len(members), x[members].astype(np.int64).tobytes(), up.tobytes(), b"", b"", flat(ids, np.int64), flat(none, np.bool_), flat(rows, np.int64), sizes)
                return at
            ways = min(fan, math.ceil(len(members) / leaf))
            chosen = members[np.linspace(0, len(members) - 1, ways).astype(int)]
            d = np.stack([space.distance(x[members], x[c]) for c in chosen])
            group = d.argmin(axis=0)
            if np.bincount(group).max() == len(members):  # nothing is parted by distance: cut evenly
                group = np.arange(len(members)) * ways // len(members)
            parts = [(c, np.flatnonzero(group == g), d[g]) for g, c in enumerate(chosen) if (group == g).any()]
            children = [page(members[w], x[c], own[w]) for c, w, own in parts]
            radius = np.array([own[w].max() for _, w, own in parts])
            routing_rows = x[[c for c, _, _ in parts]]
            pages[at] = (seed, part, at, False, len(parts), routing_rows.astype(np.int64).tobytes(), space.distance(routing_rows, routing).tobytes(), radius.tobytes(), np.array(children, dtype=np.int32).tobytes(), b"", b"", b"", b"")
            return at

        page(np.arange(len(x)), seeds[seed], space.distance(x, seeds[seed]))
        return pd.DataFrame(pages, columns=[c.split()[0] for c in PAGES.split(", ")])

    return run


class Page:
    """An unpacked page."""

    def __init__(self, r, space: Space) -> None:
        self.leaf, self.x = r.leaf, space.rows(bytes(r.z)) if space.dim else np.zeros((r.n, 0))
        self.up = np.frombuffer(r.up)
        if self.leaf:
            self.radius = np.zeros(r.n)
            end = np.cumsum(np.frombuffer(r.sizes, dtype=np.int32))
            none, ids, rows = np.frombuffer(r.none, dtype=np.bool_).tolist(), np.frombuffer(r.ids, dtype=np.int64).tolist(), np.frombuffer(r.rows, dtype=np.int64).tolist()
            every = list(zip(none, ids, rows))
            self.rows = [every[a:b] for a, b in zip([0, *end[:-1].tolist()], end.tolist())]
        else:
            self.radius, self.child = np.frombuffer(r.radius), np.frombuffer(r.child, dtype=np.int32).tolist()


def best_first(pages: dict[int, Page], q: np.ndarray, space: Space, routing: np.ndarray, most: int, least: float) -> tuple[list, int]:
    """The best ``most`` rows (-score, null id, id, row) of a subtree, none of them below ``least``, and how many products it took."""
    base = space.base(q)
    wide = SLACK * math.sqrt(base) + SLACK
    limit = float(space.reach(base, np.float64(least))) + wide if least > -math.inf else math.inf
    heap, best, computed = [(0.0, 0, float(space.reach(base, routing @ q)))], [], 1
    while heap:
        low, at, dq = heapq.heappop(heap)
        if low > limit:
            break
        p = pages[at]
        near = None
        if limit < math.inf:
            near = np.flatnonzero(np.abs(dq - p.up) - p.radius <= limit + wide)
            if not len(near):
                continue
            near = near if len(near) < len(p.x) else None
        dot = (p.x if near is None else p.x[near]) @ q
        computed += len(dot)
        if not p.leaf:
            d = space.reach(base, dot.astype(np.float64))
            low = d - (p.radius if near is None else p.radius[near])
            for k in np.flatnonzero(low <= limit).tolist():
                heapq.heappush(heap, (max(float(low[k]), 0.0), p.child[k if near is None else near[k]], float(d[k])))
            continue
        ok = np.flatnonzero(dot >= least)
        if len(ok):
            best += [(-int(dot[k]), *r) for k in ok.tolist() for r in p.rows[k if near is None else near[k]]]
            best.sort()
            del best[most:]
            if len(best) == most and -best[-1][0] > least:
                least = -best[-1][0]
                limit = float(space.reach(base, np.float64(least))) + wide
    return best, computed


def visit(space: Space, seeds: np.ndarray, most: int):
    """cogroup: a block of queries (e, z, least) and the pages of a subtree to the best rows of each query."""

    def run(key: tuple, queries: pd.DataFrame, pages: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(pages):
            tree = {r.page: Page(r, space) for r in pages.itertuples()}
            routing = seeds[int(key[0])]
            least = queries["least"].fillna(-math.inf).tolist()
            for e, q, floor in zip(queries["e"].tolist(), space.rows(queries["z"]) if space.dim else np.zeros((len(queries), 0)), least):
                out += [(e, -s, None if none else i, none, row) for s, none, i, row in best_first(tree, q, space, routing, most, floor)[0]]
        f = pd.DataFrame(out, columns=["e", "score", "vec_id", "none", "row"])
        f["vec_id"] = f["vec_id"].astype("Int64")
        return f

    return run


def first(rows: DataFrame, key: str, most: int) -> DataFrame:
    """The best ``most`` rows of each key, with their rank."""
    w = Window.partitionBy(key).orderBy(F.col("score").desc(), "none", "vec_id", "row")
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most)


def excluded_by_root(space: Space, seeds: np.ndarray, radius: np.ndarray, parts: list[int]):
    """mapInPandas: queries (e, z, least, seed, part) to one row for each subtree that may hold a better row; (seed, part) is searched already."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in it:
            out = []
            for e, z, q, least, seed, part in zip(f["e"].tolist(), f["z"], space.rows(f["z"]), f["least"], f["seed"], f["part"]):
                base = space.base(q)
                d = space.reach(base, (seeds @ q).astype(np.float64))
                wide = SLACK * math.sqrt(base) + SLACK
                limit = math.inf if least is None or math.isnan(least) else float(space.reach(base, np.float64(least))) + 2 * wide
                out += [(e, z, least, s, p) for s in np.flatnonzero(d - radius <= limit).tolist() for p in range(parts[s]) if (s, p) != (seed, part)]
            yield pd.DataFrame(out, columns=["e", "z", "least", "seed", "part"])

    return run


def top_products(
    table: DataFrame, queries: Column, *, vec_id: str = "vec_id", vector: str = "embedding", scale: int = 64, most: int = 20,
    leaf: int = LEAF, fan: int = FAN,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``most`` largest products of each query row, largest first.

    ``queries``: condition on the rows of ``table`` that are queried.  ``leaf``,
    ``fan``: entries of a leaf page and of an inner page.
    """
    spark = table.sparkSession
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1024")
    t = table.select(F.col(vec_id).alias("id"), F.col(vector).alias("v"), F.coalesce(queries, F.lit(False)).alias("asked")).where(usable(F.col("v")))
    t = t.select("id", (F.col("asked") & F.col("id").isNotNull()).alias("asked"), F.transform("v", lambda x: F.floor(x.cast("double") * float(scale))).alias("v"))
    size = t.agg(F.max(F.size("v")).alias("dim"), F.max(F.array_max(F.transform("v", lambda x: F.abs(x.cast("double"))))).alias("most")).first()
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    if size["dim"] is None:
        return empty
    dim = size["dim"]
    if dim * (size["most"] or 0.0) ** 2 >= 2.0**60:
        raise ValueError("components too large for exact products")
    # written: the row numbers must not change when a task runs again
    t = durable(t.select(F.monotonically_increasing_id().alias("row"), "id", "asked", packed(dim)("v").alias("z")))

    w = Window.partitionBy("z").orderBy(F.col("id").asc_nulls_last(), "row")
    few = t.withColumn("r", F.row_number().over(w)).where(F.col("r") <= most + 1)
    few = few.groupBy("z").agg(F.array_sort(F.collect_list(F.struct("r", "id", "row"))).alias("m")).join(t.where("asked").select("z").distinct().withColumn("asked", F.lit(True)), "z", "left")
    few = few.select(
        F.monotonically_increasing_id().alias("e"), "z", F.coalesce("asked", F.lit(False)).alias("asked"),
        F.transform("m", lambda x: F.coalesce(x["id"], F.lit(0))).alias("ids"), F.transform("m", lambda x: x["id"].isNull()).alias("none"), F.col("m.row").alias("rows"),
    )
    objects = durable(few)

    def longest(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in it:
            x = Space(dim, 1 << 62).rows(s)
            yield pd.Series((x * x).sum(axis=1), dtype=np.int64)

    longest.__annotations__ = {"it": Iterator[pd.Series], "return": Iterator[pd.Series]}
    n, top = objects.select(F.pandas_udf(longest, "bigint")("z").alias("l")).agg(F.count(F.lit(1)), F.max("l")).first()
    space = Space(dim, int(top))
    roots = objects.orderBy(F.xxhash64("z"), "z").limit(min(ROOTS, math.ceil(n / TREE))).select("z").collect()
    seeds = space.rows([r["z"] for r in roots]) if dim else np.zeros((len(roots), 0))

    placed = objects.withColumn("s", nearest_seed(space, seeds)("z"))
    placed = durable(placed.select("e", "z", "asked", "ids", "none", "rows", "s.*"))
    sizes = {r["seed"]: r for r in placed.groupBy("seed").agg(F.count(F.lit(1)).alias("n"), F.max("d").alias("r"), F.count(F.when(F.col("asked"), 1)).alias("q")).collect()}
    parts = [math.ceil(sizes[s]["n"] / TREE) if s in sizes else 0 for s in range(len(seeds))]
    radius = np.array([sizes[s]["r"] if s in sizes else 0.0 for s in range(len(seeds))]) * (1 + SLACK) + SLACK
    part = F.pmod(F.xxhash64("z", F.lit(1)), F.element_at(F.array(*[F.lit(max(1, p)) for p in parts]), F.col("seed") + 1)).cast("int")
    placed = placed.withColumn("part", part)
    pages = durable(placed.select("seed", "part", "z", "ids", "none", "rows").groupBy("seed", "part").applyInPandas(build(space, seeds, leaf, fan), PAGES))

    blocks = max(1, math.ceil(sum(r["q"] for r in sizes.values()) / BLOCK))
    block = F.pmod(F.xxhash64("e"), F.lit(blocks)).cast("int")
    spread = pages.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    keys = ["seed", "part", "block"]

    def searched(asked: DataFrame) -> DataFrame:
        return asked.withColumn("block", block).groupBy(*keys).cogroup(spread.groupBy(*keys)).applyInPandas(visit(space, seeds, most + 1), FOUND)

    asked = placed.where("asked").select("e", "z", "seed", "part")
    home = durable(searched(asked.withColumn("least", F.lit(None).cast("double"))))
    # the score at rank most + 1: the query's own row may be among those before it
    least = home.groupBy("e").agg(F.count(F.lit(1)).alias("n"), F.min("score").cast("double").alias("least")).where(F.col("n") > most).drop("n")
    asked = durable(asked.join(least, "e", "left").select("e", "z", "least", "seed", "part"))
    away = asked.mapInPandas(excluded_by_root(space, seeds, radius, parts), "e bigint, z binary, least double, seed int, part int")
    found = durable(first(home.union(searched(away)), "e", most + 1).drop("rank"))
    rows = t.where("asked").select("z", F.col("id").alias("query_id"), F.col("row").alias("q")).join(asked.select("z", "e"), "z").drop("z")
    found = first(found.join(rows, "e").where(F.col("row") != F.col("q")), "q", most)
    return found.select(F.col("query_id").cast("bigint").alias("query_id"), "rank", "vec_id", "score")
