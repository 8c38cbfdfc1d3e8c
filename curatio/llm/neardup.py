"""MinHash near-duplicates with min-max hashing.

A text's set holds its distinct shingles of ``SHINGLE`` words (64-bit
hashes).  Each of ``PERMS`` permutations keeps both the smallest and the
largest value of the set, so 64 evaluations give 128 values; four minima, or
four maxima, make a band.  At a similarity of 0.75 a pair misses all 32 bands
with probability 5e-6.

Texts with equal sets form a class, found by a digest of the set; one member
stands for it, so copies are never expanded into pairs.  In each band bucket
every representative is paired with the bucket's leader, the member that
meets most others in all its buckets; pairs are confirmed on full sets and
contracted to components.  Two members of one component need no further
check, so only members of buckets that still span several components go on:
they are hashed again, with ``FINE_PERMS`` permutations.  ``FINE_BANDS`` bands of
``FINE_ROWS`` of these values part families of half-similar texts; members that
meet there are paired across components if their sketches, ``BITS`` bits of every
value, differ in few enough bits.  The sketches are long, so that a pair has to come
close to the limit to be confirmed on full sets (a pair at 0.75 is missed with
probability 1.1e-5).  Buckets are aggregated, joined and compared block by block, never
collected, so a bucket may hold any share of the documents.

Defined results: texts without words have an empty set and no links; rows that
share an id are one node; a null id takes no part, its component is null and
it stays; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatio.llm.common import LOWER, durable, mix, packed, per_text, prepare, unpacked, window_hashes, word_hashes
from curatio.llm.links import components

SHINGLE = 5
PERMS, ROWS = 64, 4
FINE_PERMS, FINE_ROWS, FINE_BANDS = 2160, 8, 112
BITS = 2  # of each value in a sketch
BLOCK = 1024  # members of a bucket that are compared at a time
PERCENT = 75
DDL = "n long, cls binary, bands array<long>"
FIELDS = ["n", "cls", "bands"]
_CELLS = 1 << 18  # hash values held at a time


def shingles(text: bytes | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes; fewer words than ``size`` make one shingle."""
    words = (text or b"").translate(LOWER).split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = word_hashes(words)
    if len(h) < size:
        return mix(window_hashes(h, len(h)) + np.uint64(len(h)))
    return np.unique(window_hashes(h, size))


def signature(s: np.ndarray, perms: int = PERMS) -> np.ndarray:
    """Minima, then maxima, of the set under every permutation (products with odd numbers)."""
    odd = mix(np.arange(1, perms + 1, dtype=np.uint64)) | np.uint64(1)
    low = np.full(perms, np.iinfo(np.uint64).max, dtype=np.uint64)
    high = np.zeros(perms, dtype=np.uint64)
    step = max(1, _CELLS // perms)
    for i in range(0, len(s), step):
        x = s[i : i + step, None] * odd[None, :]
        np.minimum(low, x.min(axis=0), out=low)
        np.maximum(high, x.max(axis=0), out=high)
    return np.concatenate([low, high])


def bands(sig: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key a band (``rows`` values and the band's number)."""
    g = sig.reshape(-1, rows)
    key = np.arange(len(g), dtype=np.uint64)
    for j in range(rows):
        key = mix(key + g[:, j])
    return key.view(np.int64)


def describe(text: bytes | None) -> tuple:
    s = shingles(text)
    if not len(s):
        return 0, None, []
    return len(s), xxhash.xxh3_128_digest(s.tobytes()), bands(signature(s))


def fine(z: bytes | None) -> tuple:
    sig = signature(shingles(unpacked(z)), FINE_PERMS)
    v = mix(sig)
    bits = np.packbits(((v[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8))
    return bands(sig[: FINE_BANDS * FINE_ROWS], FINE_ROWS), bits.tobytes()


def differing(percent: int) -> float:
    """Bits in which the sketches of a similar enough pair differ at most, but for one in 300,000 at the limit.

    Values of a pair of similarity j agree with probability j, and else each of their bits does by half.
    """
    q, values = 1 - percent / 100, 2 * FINE_PERMS
    mean, square = q * BITS / 2, q * (BITS / 4 + BITS * BITS / 4)
    return values * mean + 4.5 * (values * (square - mean * mean)) ** 0.5


def across(percent: int):
    """mapInPandas over members sorted by bucket and pair of blocks: pairs of two components with close sketches."""
    most = differing(percent)

    def pairs(f: pd.DataFrame) -> Iterator[tuple[int, int]]:
        ids, n, c, block = (f[x].to_numpy() for x in ("id", "n", "c", "block"))
        bits = np.frombuffer(b"".join(f["bits"]), dtype=np.uint64).reshape(len(f), -1)
        one = f["i"].iloc[0] == f["j"].iloc[0]
        for r in range(len(f) - 1):
            ok = (c[r + 1 :] != c[r]) & (percent * np.maximum(n[r + 1 :], n[r]) <= 100 * np.minimum(n[r + 1 :], n[r]))
            at = r + 1 + np.flatnonzero(ok if one else ok & (block[r + 1 :] != block[r]))
            if len(at):
                at = at[np.bitwise_count(bits[at] ^ bits[r]).sum(axis=1, dtype=np.int64) <= most]
                yield from ((max(ids[r], x), min(ids[r], x)) for x in ids[at].tolist())

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for f in it:
            rest = f if rest is None else pd.concat([rest, f], ignore_index=True)
            cut = np.flatnonzero((rest[["key", "i", "j"]].to_numpy()[1:] != rest[["key", "i", "j"]].to_numpy()[:-1]).any(axis=1)) + 1
            edges = [0, *cut.tolist()]
            out = [p for a, b in zip(edges, edges[1:]) for p in pairs(rest.iloc[a:b])]
            yield pd.DataFrame(out, columns=["a", "b"])
            rest = rest.iloc[edges[-1] :].reset_index(drop=True)  # the last group may go on
        if rest is not None and len(rest):
            yield pd.DataFrame(list(pairs(rest)), columns=["a", "b"])

    return run


def linked(percent: int):
    """UDF: do two compressed texts share at least ``percent`` of their united shingles?"""

    def run(it: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        last: tuple[bytes, np.ndarray] | None = None
        for left, right in it:
            out = []
            for a, b in zip(left, right):
                if last is None or last[0] != b:
                    last = (b, shingles(unpacked(b)))
                s, t = shingles(unpacked(a)), last[1]
                if percent * max(len(s), len(t)) > 100 * min(len(s), len(t)):
                    out.append(False)
                    continue
                both = len(np.intersect1d(s, t, assume_unique=True))
                out.append(len(s) > 0 and 100 * both >= percent * (len(s) + len(t) - both))
            yield pd.Series(out, dtype=bool)

    run.__annotations__ = {"it": Iterator[tuple[pd.Series, pd.Series]], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "boolean")


def confirm(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    one = texts.select(F.col("id").alias("a"), F.col("z").alias("ta"))
    two = texts.select(F.col("id").alias("b"), F.col("z").alias("tb"))
    met = pairs.join(one, "a").join(two, "b")
    return met.where(linked(percent)("ta", "tb")).select("a", "b")


def near(small: Column, large: Column, percent: int) -> Column:
    """Can sets of these sizes be similar enough?"""
    return F.lit(percent) * F.greatest(small, large) <= F.lit(100) * F.least(small, large)


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row a document."""
    prepare(docs.sparkSession)
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    rows = durable(texts.select("id", per_text(lambda: describe, DDL, FIELDS)(F.col("text")).alias("r")).select("id", "r.*"))
    sets = rows.where("id IS NOT NULL AND n > 0")
    classes = durable(sets.groupBy("cls").agg(F.min_by(F.struct("n", "bands"), "id").alias("r"), F.min("id").alias("rep")).select("cls", "rep", "r.n", "r.bands"))
    keyed = classes.select(F.col("rep").alias("id"), "n", F.explode("bands").alias("key"))
    shared = durable(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1"))
    met = durable(keyed.join(shared, "key"))
    # the member that meets most others in all its buckets leads its buckets: an original, not one of its copies
    pull = durable(met.groupBy("id").agg(F.sum("m").alias("pull")))
    met = durable(met.join(pull, "id").select("key", "id", "n", "pull"))
    lead = F.struct((-F.col("pull")).alias("pull"), "id", "n")
    pivot = durable(met.groupBy("key").agg(F.min(lead).alias("p")).select("key", F.col("p.id").alias("p"), F.col("p.n").alias("pn")))
    met = durable(met.join(pivot, "key").select("key", "id", "n", "p", "pn"))
    star = met.where((F.col("id") != F.col("p")) & near(F.col("n"), F.col("pn"), percent))
    texts = texts.select("id", packed()(F.col("text")).alias("z"))
    star = durable(star.select(F.greatest("id", "p").alias("a"), F.least("id", "p").alias("b")).distinct())
    links = durable(confirm(star, texts, percent))
    # one id under several sets joins their classes
    own = sets.select("id", "cls").join(classes.select("cls", "rep"), "cls")
    shared = own.groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a <> b").select("a", "id")
    shared = shared.join(own.select("id", F.col("rep").alias("b")), "id").select("a", "b")
    links = durable(links.unionByName(shared))
    comp = durable(components(links))

    # buckets that still span several components: pairs across them
    named = met.join(comp.withColumnRenamed("node", "id"), "id", "left").withColumn("c", F.coalesce("component", "id"))
    named = durable(named.select("key", "id", "n", "c"))
    span = named.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("key")
    rest = durable(named.join(durable(span), "key", "left_semi").select("id", "n", "c").distinct())
    if not rest.isEmpty():
        cut = per_text(lambda: fine, "keys array<long>, bits binary", ["keys", "bits"])
        rest = durable(rest.join(texts, "id").select("id", "n", "c", cut(F.col("z")).alias("r")).select("id", "n", "c", "r.*"))
        keys = rest.select("id", "n", "c", F.explode("keys").alias("key"))
        span = keys.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count(F.lit(1)).alias("m")).where("lo <> hi")
        span = durable(span.select("key", F.ceil(F.col("m") / F.lit(BLOCK)).alias("blocks")))
        keys = keys.join(span, "key").withColumn("block", F.pmod(F.xxhash64("id"), "blocks"))
        # a member meets its own block and each of the others once: no task holds more than two blocks
        keys = keys.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        keys = keys.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "id", "n", "c")
        keys = durable(keys.join(rest.select("id", "bits"), "id"))
        more = keys.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInPandas(across(percent), "a long, b long")
        more = durable(more.distinct().join(star, ["a", "b"], "left_anti"))
        links = links.unionByName(confirm(more, texts, percent))
        comp = durable(components(links))

    low = classes.join(comp, classes["rep"] == comp["node"], "left").select("cls", F.coalesce("component", "rep").alias("component"))
    out = rows.select("id", "n", "cls").join(low, "cls", "left")
    cid = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    # rows of one id that lack words follow the id's other rows only if they are linked there
    return out.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), cid.alias("component_id"),
        F.coalesce(F.col("id") == cid, F.lit(True)).alias("kept"),
    )
