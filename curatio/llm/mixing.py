"""Mixing sources to target weights with DataFrame operations only.

The words of a source form one stream, documents in a pseudorandom order, cut
into blocks of ``block`` words (the last one may be shorter).  Targets follow
the weights: ``share`` times all words is dealt by weight, a source takes at
most ``most`` times its own words, and what it can't take is dealt again among
the others by weight until none is above.

Output shards of ``SHARD`` slots each draw the source of every slot from the
targets' shares, which makes the counts of a shard multinomial.  The slots of
a source are numbered through all shards; slot ``j`` takes block
``perm(j mod n)`` of the source's ``n`` blocks, ``perm`` being a pseudorandom
permutation of the indices for each pass (epoch) over the source.  A last
settlement shard adds the slots that the draw left short of the target, and
slots beyond it are left out, so that a source's words come to within a block
of its target and no block is taken more often than ``most`` allows.  Blocks
join slots by index.

Every number comes from hashes of the data and ``seed``, so reruns agree, and
a recomputed task draws the same slots.  Running sums are taken in two levels
(groups of bounded size, then the groups), so a source that holds a third of
all documents is spread over many tasks.

Defined results: a null or empty text has size 0 and is taken 0 times; a
source without words has target 0; a null source is a source of its own, last
in the order; repeated documents are separate rows; other columns don't matter.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curatio.llm.common import durable

BLOCK = 64
SHARD = 4096
GROUP = 4096
WEIGHTS = (3.0, 1.0, 2.0)
SHARE, MOST = 1.5, 2
BUCKETS = 4096
# The largest primes below 2^56 ... 2^63, all above any block count.
PRIMES = tuple((1 << p) - d for p, d in ((56, 5), (57, 13), (58, 27), (59, 55), (60, 93), (61, 1), (62, 57), (63, 25)))


def words(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def unit(*cols: Column) -> Column:
    """A pseudorandom number in [0, 1) from a hash."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11).cast("double") / F.lit(float(1 << 53))


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(src, source_size) -> with ``target``: one row a source, dealt by weight under the caps.

    The dealing's fixed point gives each source ``min(cap, level * weight)``;
    sources fill up in the order of cap / weight, so running sums find the level.
    """
    rank = F.row_number().over(Window.orderBy(F.col("src").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (rank % len(weights) + 1).cast("int"))
    d = sizes.withColumn("w", w).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    full = Window.orderBy(F.col("cap") / F.col("w"), F.col("src").asc_nulls_first())
    before = full.rowsBetween(Window.unboundedPreceding, -1)
    onward = full.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    d = d.withColumn("rest", F.sum("source_size").over(whole) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    d = d.withColumn("at", F.col("rest") / F.sum("w").over(onward))
    # sources before the first that its share does not fill are full; that one sets the level of the rest
    ordered = full.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = F.first(F.when(F.col("at") * F.col("w") <= F.col("cap"), F.col("at")), ignorenulls=True).over(ordered)
    d = d.withColumn("level", level)
    t = F.least("cap", F.coalesce(F.col("level") * F.col("w"), F.col("cap")))
    return d.select("src", "source_size", F.coalesce(t, F.lit(0.0)).alias("target"))


def running(d: DataFrame, keys: list[str], group: str, order: list[Column], value: str, out: str) -> DataFrame:
    """Sum of ``value`` over the rows before, by key: inside groups, then over the groups of a key."""
    inside = Window.partitionBy(*keys, group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    sums = d.groupBy(*keys, group).agg(F.sum(value).alias("__g"))
    over = Window.partitionBy(*keys).orderBy(group).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("__g", F.coalesce(F.sum("__g").over(over), F.lit(0)))
    named = sums.select(*[F.col(k).alias(f"__{k}") for k in [*keys, group]], "__g")
    on = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in [*keys, group]]
    d = d.withColumn(out, F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return d.join(named, on).withColumn(out, F.col(out) + F.col("__g")).drop("__g", *[f"__{k}" for k in [*keys, group]])


def permuted(j: Column, n: Column, *key: Column) -> Column:
    """Place of index ``j`` in [0, ``n``) under the affine permutation that ``key`` draws.

    The multiplier is a product of two of ``PRIMES``; each exceeds ``n``, so
    it shares no factor with it and the map is a bijection.
    """
    wide = lambda c: c.cast("decimal(19,0)")
    primes = F.array(*[F.lit(p) for p in PRIMES])
    pick = lambda k: F.element_at(primes, (F.pmod(F.xxhash64(F.lit(k), *key), F.lit(len(PRIMES))) + 1).cast("int")) % n
    a = ((wide(pick(1)) * wide(pick(2))) % wide(n)).cast("long")
    shifted = (wide(a) * wide(j)) % wide(n)
    return ((shifted.cast("long") + F.pmod(F.xxhash64(F.lit(3), *key), n)) % n).cast("long")


class Mix(NamedTuple):
    """``docs``: doc_id, src, src_no, size, at (place in its source's stream; size 0: null).
    ``sources``: src, src_no, source_size, target, n_blocks, n_slots.
    ``slots``: src_no, shard, j, epoch, block - the blocks that each output shard takes.
    ``pieces``: doc_id, src_no, at, size, block, begin, n - the words of each document in each block.
    """

    docs: DataFrame
    sources: DataFrame
    slots: DataFrame
    pieces: DataFrame


def draw(spark, sources: DataFrame, seed: int) -> DataFrame:
    """Slots by shard: multinomial counts, numbered by source, settled to ``n_slots``."""
    live = sources.where("n_slots > 0").select("src_no", "n_blocks", "n_slots")
    total = live.agg(F.sum("n_slots")).first()[0] or 0
    by = Window.orderBy("src_no")
    cum = F.coalesce(F.sum("n_slots").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    dealt = live.withColumn("lo", cum / F.lit(float(max(total, 1))))
    dealt = dealt.withColumn("hi", F.coalesce(F.lead("lo").over(by), F.lit(2.0)))
    last = F.least(F.floor(F.col("hi") * BUCKETS), F.lit(BUCKETS - 1))
    cells = dealt.select("src_no", "lo", "hi", F.explode(F.sequence(F.floor(F.col("lo") * BUCKETS), last)).alias("cell"))
    u = spark.range(total).select((F.col("id") / SHARD).cast("long").alias("shard"), unit(F.lit(seed), F.col("id")).alias("u"))
    u = u.withColumn("cell", F.floor(F.col("u") * BUCKETS))
    drawn = u.join(cells, "cell").where("u >= lo AND u < hi").groupBy("src_no", "shard").agg(F.count(F.lit(1)).alias("n"))
    drawn = durable(drawn)
    shards = -(-total // SHARD)
    sums = drawn.groupBy("src_no").agg(F.sum("n").alias("n"))
    short = live.join(sums, "src_no", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    settle = short.where("n_slots > n").select("src_no", F.lit(shards).cast("long").alias("shard"), (F.col("n_slots") - F.col("n")).alias("n"))
    runs = drawn.unionByName(settle).withColumn("group", (F.col("shard") / GROUP).cast("long"))
    runs = running(runs, ["src_no"], "group", [F.col("shard")], "n", "first").join(live, "src_no")
    n = F.least(F.col("n"), F.col("n_slots") - F.col("first"))
    runs = runs.withColumn("n", n).where("n > 0")
    j = runs.select("src_no", "shard", "n_blocks", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)).alias("j"))
    epoch = F.floor(F.col("j") / F.col("n_blocks"))
    j = j.withColumn("epoch", epoch)
    place = permuted(F.col("j") - F.col("epoch") * F.col("n_blocks"), F.col("n_blocks"), F.lit(seed), F.col("src_no"), F.col("epoch"))
    return j.select("src_no", "shard", "j", "epoch", place.alias("block"))


def mix(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source", block: int = BLOCK,
    weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = 7,
) -> Mix:
    spark = docs.sparkSession
    d = durable(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("src"), words(F.col(text)).alias("size")))
    groups = -(-max(d.count(), 1) // GROUP)
    sources = targets(d.groupBy("src").agg(F.sum("size").alias("source_size")), weights, share, most)
    blocks = F.ceil(F.col("source_size") / F.lit(block)).cast("long")
    slots = F.when(F.col("source_size") > 0, F.round(F.col("target") * blocks / F.col("source_size")).cast("long")).otherwise(F.lit(0).cast("long"))
    sources = durable(sources.select(
        "*", (F.row_number().over(Window.orderBy(F.col("src").asc_nulls_last())) - 1).alias("src_no"),
        blocks.alias("n_blocks"), slots.alias("n_slots"),
    ))
    s = sources.select(F.col("src").alias("__src"), "src_no")
    d = d.join(s, d["src"].eqNullSafe(s["__src"])).drop("__src")
    draws = F.xxhash64(F.lit(seed), F.col("doc_id"))
    some = d.where("size > 0").withColumn("order", draws).withColumn("group", F.pmod(F.col("order"), F.lit(groups)))
    some = running(some, ["src_no"], "group", [F.col("order"), F.col("doc_id"), F.col("size")], "size", "at")
    some = some.select("doc_id", "src", "src_no", "size", "at")
    none = d.where("size = 0").select("doc_id", "src", "src_no", "size", F.lit(None).cast("long").alias("at"))
    b = F.lit(block)
    first, last = F.floor(F.col("at") / b), F.floor((F.col("at") + F.col("size") - 1) / b)
    p = some.select("doc_id", "src_no", "at", "size", F.explode(F.sequence(first, last)).alias("block"))
    begin = F.greatest(F.col("block") * b - F.col("at"), F.lit(0))
    end = F.least((F.col("block") + 1) * b - F.col("at"), F.col("size"))
    p = p.withColumn("begin", begin).withColumn("n", end - F.col("begin"))
    return Mix(some.unionByName(none), sources, draw(spark, sources, seed), p)


def mixed(m: Mix) -> DataFrame:
    """The output itself: for each shard and slot the words ``begin`` .. ``begin + n`` of a document."""
    return m.slots.join(m.pieces, ["src_no", "block"]).select("shard", "src_no", "j", "block", "doc_id", "begin", "n")


def taken(m: Mix) -> DataFrame:
    """doc_id, src, size, source_size, target, taken: one row a document, repeats counted."""
    times = m.slots.groupBy("src_no", "block").agg(F.count(F.lit(1)).alias("times"))
    got = m.pieces.join(times, ["src_no", "block"]).groupBy("src_no", "at").agg(F.sum(F.col("n") * F.col("times")).alias("taken"))
    out = m.docs.join(got, ["src_no", "at"], "left")
    out = out.join(m.sources.drop("src"), "src_no")
    return out.select(
        "doc_id", "src", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )
