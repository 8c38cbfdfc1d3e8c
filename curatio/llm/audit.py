"""Filter interaction audit: what each of five text filters removes, in every order of application.

A sparse document-term matrix carries the word counts.  Texts are cut into
shards of about ``SHARD_BYTES``; a shard codes its words by its own vocabulary
first, in the order of their hashes.  For the global dictionary each shard sends each
of its words once, packed by range of the hash, to that range's bucket; as many
buckets as keep ``BUCKET`` words in each.  A bucket numbers its distinct words (they,
not their hashes, are compared), and its number with theirs is the global
column id.  The numbers go back to the shards, which become CSR: ``indptr``,
column ids ``indices``, counts ``data``.  A row's sum is its number of words
(filter A), its number of nonzeros the number of distinct words (filter B).
Upper case (C), symbols (D) and equality with an earlier text (E, by the text's
SHA-256 and the smallest id of each digest) are attached to the rows.  What is
left is counted by part and set of failed filters, at most 32 sets a part,
and only those counts meet the 120 orders.

Filters: A under 100 words; B distinct words under 80 % of all; C over 10 % of
the code points in A-Z; D any of ``#$%&*|``; E the same text under a smaller id.

Defined results: a null text is empty (0 words: A fails; B, C and D hold);
empty texts are equal texts; a null part is the empty string; a row without an
id never fails E and makes no other row fail; repeated rows of one id count
each and don't make one another fail; a document is good (toxic) if any of its
labels says so, labels without a document or id count nowhere; without
documents there are no parts and no rows; further columns are not read.  A
shard holds whole texts, so one longer than ``SHARD_BYTES`` is a shard alone.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curatio.llm.common import durable, mix, powers, prepare

FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT, MAX_UPPER = 100, 80, 10
SHARD_BYTES = 1 << 22
# Words that the shards send to one bucket, about.
BUCKET = 1 << 20
# A shard's row is a few megabytes, so few of them share an Arrow batch.
SHARD_ROWS = "4"

DOC = "doc_id bigint, part string, digest binary, upper bigint, points bigint, symbols boolean"
LOCAL = f"shard bigint, docs array<struct<{DOC}>>, indptr array<bigint>, codes binary, data binary, n_words bigint, words binary"
PIECES = "bucket bigint, shard bigint, words binary"
RANKS = "bucket bigint, shard bigint, ranks binary"
UPPER = bytes(range(65, 91))
SYMBOLS = b"#$%&*|"


def names(ddl: str) -> list[str]:
    """Top-level column names of a schema without further commas outside brackets."""
    return [f.split(" ")[0] for f in re.sub("<.*?>+", "", ddl).split(", ")]


def pack(numbers: np.ndarray) -> bytes:
    """32-bit numbers, compressed by their bytes' places."""
    import zstandard

    return zstandard.ZstdCompressor(level=3).compress(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def unpack(z: bytes) -> np.ndarray:
    import zstandard

    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(z)), dtype=np.uint8)
    return np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def squeeze(words: pa.Array) -> bytes:
    """Words, none of which holds a blank, compressed."""
    import zstandard

    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], type=pa.int32()), words), " ")
    return zstandard.ZstdCompressor(level=1).compress(joined[0].as_buffer())


def words_of(z: bytes) -> pa.Array:
    import zstandard

    return split([zstandard.ZstdDecompressor().decompress(bytes(z))])[0]


def split(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The words of texts (maximal runs without ASCII white space) and the number of the text that each is from."""
    # bytes are parted at ASCII blanks whatever they encode: seen as a string without a check
    parts = pc.ascii_split_whitespace(pa.array(texts, type=pa.binary()).view(pa.string()))
    row, flat = np.repeat(np.arange(len(texts)), np.diff(parts.offsets.to_numpy())), parts.flatten()
    some = pc.binary_length(flat).to_numpy() > 0  # blanks at an end leave an empty part
    return flat.filter(pa.array(some)), row[some]


def hashes(words: pa.Array) -> np.ndarray:
    """64-bit hash of each word: its bytes and its length as a polynomial, mixed."""
    words = pa.concat_arrays([words])  # from offset 0
    offsets = np.frombuffer(words.buffers()[1], dtype=np.int32)[: len(words) + 1].astype(np.int64)
    data = np.frombuffer(words.buffers()[2] or b"", dtype=np.uint8)[: offsets[-1]]
    size = np.diff(offsets)
    if not len(size):
        return np.empty(0, dtype=np.uint64)
    power = powers(int(size.max()) + 1)
    h = np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * power[np.arange(len(data)) - np.repeat(offsets[:-1], size)], offsets[:-1])
    return mix(h + size.astype(np.uint64) * power[1])


def by_hash(words: pa.Array) -> np.ndarray:
    """Order of different words by (hash, word)."""
    h = hashes(words)
    order = np.argsort(h, kind="stable")
    same = np.flatnonzero(np.diff(h[order]) == 0)
    if len(same):
        order = np.array(sorted(order.tolist(), key=lambda i: (int(h[i]), words[i].as_buffer().to_pybytes())))
    return order


class Shard:
    """Documents gathered so far."""

    def __init__(self) -> None:
        self.docs, self.texts, self.bytes = [], [], 0

    def add(self, doc_id: int | None, part: str, text: bytes) -> None:
        points = int(np.count_nonzero(np.frombuffer(text, dtype=np.int8) >= -64))  # bytes that go on a character are below
        upper, symbols = len(text) - len(text.translate(None, UPPER)), len(text.translate(None, SYMBOLS)) < len(text)
        self.docs.append((doc_id, part, hashlib.sha256(text).digest(), upper, points, symbols))
        self.texts.append(text)
        self.bytes += len(text)

    def row(self, number: int) -> tuple:
        """The shard with its words, and so their codes, in the order of (hash, word)."""
        words, row = split(self.texts)
        coded = words.dictionary_encode()
        order = by_hash(coded.dictionary)
        code = np.empty(len(order), dtype=np.int64)
        code[order] = np.arange(len(order))
        entry, n = np.unique(row << 32 | code[coded.indices.to_numpy()], return_counts=True)
        indptr = np.searchsorted(entry, np.arange(len(self.texts) + 1) << 32)
        fields = names(DOC)
        docs = [dict(zip(fields, d)) for d in self.docs]
        return number, docs, indptr, pack(entry & 0xFFFFFFFF), pack(n), len(order), squeeze(coded.dictionary.take(pa.array(order)))


def gather(most: int):
    """mapInPandas: documents to shards of about ``most`` bytes with words coded locally."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        number, shard = TaskContext.get().partitionId() << 33, Shard()
        for f in it:
            for doc_id, none, part, text in zip(f["doc_id"], f["none"], f["part"], f["text"]):
                shard.add(None if none else int(doc_id), part, bytes(text))
                if shard.bytes >= most:
                    yield pd.DataFrame([shard.row(number)], columns=names(LOCAL))
                    number, shard = number + 1, Shard()
        if shard.docs:
            yield pd.DataFrame([shard.row(number)], columns=names(LOCAL))

    return run


def dealt(buckets: int):
    """mapInPandas: a shard's words to one packed piece for each bucket, which is a range of hashes."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in it:
            for shard, z in zip(f["shard"], f["words"]):
                words = words_of(z)
                at = (hashes(words) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)  # ascending, as the hashes are
                cut = np.flatnonzero(np.diff(at)) + 1
                edges = [0, *cut.tolist(), len(words)] if len(words) else []
                yield pd.DataFrame([(int(at[a]), shard, squeeze(words[a:b])) for a, b in zip(edges, edges[1:])], columns=names(PIECES))

    return run


def ranked(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
    """applyInPandas: the pieces of a bucket to the numbers of their words among the bucket's distinct words, in hash order."""
    pieces = [words_of(z) for z in f["words"]]
    coded = pa.concat_arrays(pieces).dictionary_encode()
    order = by_hash(coded.dictionary)
    number = np.empty(len(order), dtype=np.int64)
    number[order] = np.arange(len(order))
    number = number[coded.indices.to_numpy()]
    end = np.cumsum([len(p) for p in pieces])
    # ascending, so the steps between them are small
    ranks = [pack(np.diff(number[b - len(p) : b], prepend=0)) for p, b in zip(pieces, end)]
    return pd.DataFrame({"bucket": f["bucket"], "shard": f["shard"], "ranks": ranks})


def recode(shards: Iterator[tuple]) -> Iterator[pd.DataFrame]:
    """Local codes to global column ids, ascending within each row of a shard as both follow the hashes."""
    for codes, data, buckets, ranks in shards:
        out = []
        for c, n, at, z in zip(codes, data, buckets, ranks):
            ids = [(int(b) << 32) + np.cumsum(unpack(r)) for b, r in zip(at, z)]
            out.append((np.concatenate([np.empty(0, dtype=np.int64), *ids])[unpack(c)], unpack(n).astype(np.int32)))
        yield pd.DataFrame(out, columns=["indices", "data"])


recode.__annotations__ = {"shards": Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]], "return": Iterator[pd.DataFrame]}


def totals(rows: Iterator[tuple]) -> Iterator[pd.DataFrame]:
    """Row sums and nonzero counts of CSR shards."""
    for indptr, data in rows:
        out = []
        for p, n in zip(indptr, data):
            upto = np.concatenate(([0], np.cumsum(np.asarray(n, dtype=np.int64))))
            p = np.asarray(p)
            out.append((upto[p[1:]] - upto[p[:-1]], np.diff(p)))
        yield pd.DataFrame(out, columns=["sums", "nonzeros"])


totals.__annotations__ = {"rows": Iterator[tuple[pd.Series, pd.Series]], "return": Iterator[pd.DataFrame]}


def term_matrix(docs: DataFrame, shard_bytes: int = SHARD_BYTES, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, part, text) -> one row a shard: shard, docs, indptr, indices, data (CSR with global column ids).

    ``bucket``: words that the shards send to one bucket of the dictionary, about.
    """
    spark = docs.sparkSession
    prepare(spark)
    t = docs.select(
        F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("doc_id").isNull().alias("none"),
        F.coalesce("part", F.lit("")).alias("part"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"),
    )
    local = durable(t.mapInPandas(gather(shard_bytes), LOCAL))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", SHARD_ROWS)
    sent = local.agg(F.sum("n_words")).first()[0] or 0
    pieces = local.select("shard", "words").mapInPandas(dealt(max(1, math.ceil(sent / bucket))), PIECES)
    ranks = pieces.groupBy("bucket").applyInPandas(ranked, RANKS)
    # the pieces of a shard hold no more words than its text
    back = ranks.groupBy("shard").agg(F.array_sort(F.collect_list(F.struct("bucket", "ranks"))).alias("r"))
    coded = F.pandas_udf(recode, "indices array<bigint>, data array<int>")
    at, z = F.coalesce("r.bucket", F.array().cast("array<bigint>")), F.coalesce("r.ranks", F.array().cast("array<binary>"))
    m = local.drop("words").join(back, "shard", "left").select("shard", "docs", "indptr", coded("codes", "data", at, z).alias("m"))
    return m.select("shard", "docs", "indptr", "m.indices", "m.data")


def failures(docs: DataFrame, **shards: int) -> DataFrame:
    """(doc_id, part, text) -> doc_id, part, n_words, n_distinct, fails: the letters of the filters that each row fails."""
    of = F.pandas_udf(totals, "sums array<bigint>, nonzeros array<bigint>")
    m = term_matrix(docs, **shards).select("docs", of("indptr", "data").alias("t"))
    d = m.select(F.explode(F.arrays_zip("docs", F.col("t.sums").alias("n_words"), F.col("t.nonzeros").alias("n_distinct"))).alias("r"))
    d = durable(d.select("r.docs.*", "r.n_words", "r.n_distinct"))
    again = d.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    d = d.join(again, "digest", "left")
    fail = {
        "A": F.col("n_words") < MIN_WORDS,
        "B": 100 * F.col("n_distinct") < MIN_DISTINCT * F.col("n_words"),
        "C": 100 * F.col("upper") > MAX_UPPER * F.col("points"),
        "D": F.col("symbols"),
        "E": F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)),
    }
    return d.select("doc_id", "part", "n_words", "n_distinct", F.concat(*[F.when(c, k).otherwise("") for k, c in fail.items()]).alias("fails"))


def orders() -> list[str]:
    """All orders of the filters."""
    return ["".join(p) for p in permutations(FILTERS)]


def _sum(n: str, when: Column) -> Column:
    return F.sum(F.when(when, F.col(n)).otherwise(0))


def audit(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", part: str = "lang", **shards: int) -> DataFrame:
    """part, filter_order, step and the counts of that step's filter, for every part, order and step.

    ``labels``: doc_id, quality, toxic.  ``shards``: see ``term_matrix``.  Counts: kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, and shapley, the filter's removals
    summed over all orders.
    """
    d = failures(docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(part).cast("string").alias("part"), F.col(text).alias("text")), **shards)
    marks = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    d = d.join(marks, "doc_id", "left")
    ones = lambda c: F.sum(F.coalesce(F.col(c).cast("long"), F.lit(0)))
    cells = durable(d.groupBy("part", "fails").agg(F.count(F.lit(1)).alias("n"), ones("good").alias("good"), ones("toxic").alias("toxic")))
    steps = cells.withColumn("filter_order", F.explode(F.array(*map(F.lit, orders()))))
    steps = steps.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    steps = steps.withColumn("letter", F.expr("substring(filter_order, step, 1)")).withColumn("before", F.expr("substring(filter_order, 1, step - 1)"))
    fails = F.instr("fails", F.col("letter")) > 0
    gone = F.expr("translate(before, fails, '')") != F.col("before")  # one of the earlier filters is among the failed ones
    out = steps.groupBy("part", "filter_order", "step", "letter").agg(
        _sum("n", ~fails & ~gone).alias("kept"), _sum("n", fails & ~gone).alias("removed"), _sum("n", fails & gone).alias("redundant"),
        _sum("n", F.col("fails") == F.col("letter")).alias("unique_fails"),
        _sum("good", fails & ~gone).alias("good_lost"), _sum("toxic", fails & ~gone).alias("toxic_lost"),
    )
    # 120 rows a part and filter
    return out.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "letter"))).drop("letter")
