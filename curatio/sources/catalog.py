"""Logical table names -> storage, and the small side inputs of a job."""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curatio.operators.columns import skip_columns

SIDE_LIST_SCHEMA = "healthCode STRING"


@dataclass
class Catalog:
    """Maps a logical table id to a Parquet path (or a metastore table).

    ``scan`` is the ``select * from <id>`` of the reference: a lazy read whose
    unused columns Catalyst prunes from the Parquet scan.
    """

    spark: SparkSession
    paths: Mapping[str, str] = field(default_factory=dict)
    root: str | None = None

    def path(self, name: str) -> str:
        if name in self.paths:
            return self.paths[name]
        if self.root is None:
            raise KeyError(f"unknown table {name!r}")
        return os.path.join(self.root, f"{name}.parquet")

    def scan(self, name: str, skip: Iterable[str] = ("rawData",)) -> DataFrame:
        """Full scan minus system/skipped columns."""
        if name in self.paths or self.root is not None:
            df = self.spark.read.parquet(self.path(name))
        else:
            df = self.spark.table(name)
        return skip_columns(df, skip)

    def scan_participant(self, name: str, participant: str, col: str = "healthCode") -> DataFrame:
        """Scan restricted to one participant; the predicate reaches the Parquet reader (A2)."""
        return self.scan(name).where(F.col(f"`{col}`") == F.lit(participant))


def read_side_list(spark: SparkSession, path: str, schema: str = SIDE_LIST_SCHEMA) -> DataFrame:
    """CSV list with a header row (exclusion, withdrawal, clinician ids) (A3).

    Columns are taken by name from the header, in whatever order and among
    whatever others they stand; a missing one is an error.
    """
    found = spark.read.csv(path, header=True)
    wanted = spark.createDataFrame([], schema).schema
    absent = [f.name for f in wanted if f.name not in found.columns]
    if absent:
        raise ValueError(f"{path} has no column {', '.join(absent)}; its header names {found.columns}")
    return found.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in wanted])


def inline_table(spark: SparkSession, rows: Sequence[tuple], schema: str | T.StructType) -> DataFrame:
    """Literal table bundled with the code (A4, A5)."""
    return spark.createDataFrame(list(rows), schema)


# Folders that the files of ``write_attachments`` are dealt out to: listed side by side, none very long.
FOLDERS = 256
# The handle in a path of ``write_attachments``, of either layout.
ATTACHMENT = r"handle=([^/]+?)(?:\.\d+\.txt|/[^/]*)$"


def local_folder(spark: SparkSession, path: str) -> str | None:
    """``path`` for plain file calls where Spark's own writers reach it by its local file system; else None."""
    jvm = getattr(spark, "_jvm", None)
    if jvm is None:  # Spark Connect
        return None
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.makeQualified(at).toUri().getPath() if fs.getUri().getScheme() == "file" else None


def _save(batches: Iterator[pa.RecordBatch], root: str) -> Iterator[pa.RecordBatch]:
    """Write rows ``(part, handle, value)``, sorted by the first two, into a file for each two; rows: how many files there are."""
    files, last, out, at = 0, None, None, ("", "")

    def close() -> None:
        if out is not None:
            out.close()
            os.replace(*at)

    for batch in batches:
        for part, handle, value in zip(*(batch.column(i) for i in range(3))):
            if (own := (part.as_py(), handle.as_py())) != last:
                close()
                p, h = own
                folder = f"{root}/{zlib.crc32(h.encode()) % FOLDERS:02x}"
                os.makedirs(folder, exist_ok=True)
                # hidden until whole, so what a killed attempt leaves is not read
                at = (f"{folder}/.{h}.{p}.{uuid.uuid4().hex}", f"{folder}/handle={h}.{p}.txt")
                last, out, files = own, open(at[0], "wb"), files + 1  # noqa: SIM115
            out.write(value.as_py() + b"\n")
    close()
    yield pa.RecordBatch.from_pydict({"files": pa.array([files], pa.int64())})


def write_attachments(df: DataFrame, path: str) -> None:
    """Every row ``(handle, value)`` as a text file of its own; rows of one handle in one partition of ``df`` share one, a line each.

    Handles are ids that may stand in a file's name.  Hadoop's local file system starts a process
    for each file's and folder's mode, milliseconds a time, so there the tasks write by plain
    file calls, all of them even where ``df`` has few partitions.  Elsewhere Spark writes a folder
    a handle.  ``ATTACHMENT`` finds the handle in either path.
    """
    spark = df.sparkSession
    root = local_folder(spark, path)
    rows = df.select(F.col("handle").cast("string"), F.col("value").cast("string"))
    if root is None:
        # the tasks move their own files into place, instead of the driver all of them, one by one
        rows.write.option("mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy("handle").text(path)
        return
    rows = rows.select(F.spark_partition_id().alias("part"), "handle", F.col("value").cast("binary"))
    if rows._jdf.queryExecution().toRdd().getNumPartitions() < spark.sparkContext.defaultParallelism:
        rows = rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "part", "handle")
    os.makedirs(root, exist_ok=True)
    rows.sortWithinPartitions("part", "handle").mapInArrow(partial(_save, root=root), "files bigint").agg(F.sum("files")).collect()


def _few_tasks(files: DataFrame) -> DataFrame:
    """``files`` read by fewer tasks where they are many and small.

    Spark counts each file as ``spark.sql.files.openCostInBytes`` at least, so a
    task gets a few files only.  Up to 64 such tasks are one here, as long as their bytes stay below those of one on average.
    """
    jdf = getattr(files, "_jdf", None)
    if jdf is None:  # Spark Connect
        return files
    size, n = int(jdf.queryExecution().optimizedPlan().stats().sizeInBytes()), jdf.queryExecution().toRdd().getNumPartitions()
    unit = files.sparkSession._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    most = max(n // 64, 2 * size // unit, 4 * files.sparkSession.sparkContext.defaultParallelism)
    return files.coalesce(most) if most < n else files


def attachment_files(spark: SparkSession, path: str, glob: str = "*", named: str = r"([^/]+?)(\.[^./]*)?$") -> DataFrame:
    """Payload files as ``(handle, content)``: by default the file name (without
    extension) is the handle, else the first group of ``named`` in the file's
    path (A6).  Reads are distributed over executors.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    return _few_tasks(files.select("path", "content")).select(
        F.regexp_extract(F.col("path"), named, 1).alias("handle"),
        F.col("content"),
    )
