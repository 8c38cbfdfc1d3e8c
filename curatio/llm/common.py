"""Small helpers of the package: settings, fresh names, durable cuts of a lineage, word streams."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curatio.session import checkpoint_dir, ship_package

# Rows of one Arrow batch: documents may be long, so batches stay small.
ARROW_ROWS = "256"


def prepare(spark: SparkSession) -> None:
    """Settings the operators rely on; ships the package to the Python workers."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    ship_package(spark)


def durable(df: DataFrame, rows: bool = False) -> DataFrame:
    """``df`` written as Parquet into the shared checkpoint folder and reread.

    The folder is the session's ``spark.checkpoint.dir``; only where that is
    unset (tests on one machine) a temporary folder takes its place.  Lost
    executors cost nothing: the files are shared, and columns are pruned on
    every reread.
    """
    spark = df.sparkSession
    base = checkpoint_dir(spark, fallback=os.path.join(tempfile.gettempdir(), "curatio-llm"))
    path = f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name += "_"
    return name


def put(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with ``value`` as its last column ``name``; a clashing input column goes."""
    tmp = fresh(df, "__new")
    return df.withColumn(tmp, value).drop(name).withColumnRenamed(tmp, name)


def per_text(fn: Callable[[], Callable[[bytes | None], tuple]], ddl: str, fields: list[str]) -> Callable[[Column], Column]:
    """A vectorised UDF over whole texts (as UTF-8 bytes; null stays None).

    ``fn`` is called once per Python task and returns the per-text function.
    """

    def run(it: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        one = fn()
        for s in it:
            yield pd.DataFrame([one(None if t is None else bytes(t)) for t in s], columns=fields)

    udf = F.pandas_udf(_typed(run), ddl)
    return lambda c: udf(c.cast("binary"))


def _typed(run):
    run.__annotations__ = {"it": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return run


def remainder(col: Column | str, m: int) -> Column:
    """``crc32`` of the id's text, modulo ``m`` (null for a null id)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.crc32(c.cast("string").cast("binary")) % F.lit(m)


# ASCII upper case to lower case; bytes of other characters are unchanged.
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def word_hashes(words: list[bytes], seed: int = 0) -> np.ndarray:
    """64-bit hash of each word."""
    return np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in words), dtype=np.uint64, count=len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Finalising bijection of 64-bit values (xor-shift and odd multipliers)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_BASE = 0x9E3779B97F4A7C15 | 1
_POW: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64, grown on demand."""
    have = _POW.get(0)
    if have is None or len(have[0]) < n:
        size = 1 << max(12, int(n - 1).bit_length())
        up = np.full(size, _BASE, dtype=np.uint64)
        dn = np.full(size, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
        up[0] = dn[0] = 1
        _POW[0] = have = (np.multiply.accumulate(up), np.multiply.accumulate(dn))
    return have[0][:n], have[1][:n]


def powers(n: int) -> np.ndarray:
    """The first ``n`` powers of an odd base modulo 2^64."""
    return _powers(n)[0]


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` values (prefix sums of a polynomial modulo 2^64)."""
    n = len(h)
    if n < k:
        return np.empty(0, dtype=np.uint64)
    up, dn = _powers(n)
    pre = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(h * up, out=pre[1:])
    return mix((pre[k:] - pre[:-k]) * dn[: n - k + 1])


def packed(level: int = 3) -> Callable[[Column], Column]:
    """UDF that compresses a text for its way through a shuffle."""

    def run(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import zstandard

        z = zstandard.ZstdCompressor(level=level)
        for s in it:
            yield pd.Series([None if t is None else z.compress(bytes(t)) for t in s], dtype=object)

    run.__annotations__ = {"it": Iterator[pd.Series], "return": Iterator[pd.Series]}
    udf = F.pandas_udf(run, "binary")
    return lambda c: udf(c.cast("binary"))


def unpacked(z: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(bytes(z))
