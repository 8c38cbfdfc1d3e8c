"""Session construction and lineage-cut helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings every job relies on: UTC so that ``to_date`` of a timestamp is the
# calendar day of the recorded instant, AQE for runtime partition coalescing
# and skew-join splitting, ANSI left on so that every lossy cast in the
# library is an explicit ``try_cast``.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_spark(
    master: str | None = None,
    app: str = "curatio",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or fetch) a session with the library's settings.

    On a cluster pass ``master=None`` and let the submitter decide; the
    shuffle partition count then stays whatever the cluster configured.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in BASE_CONF.items():
        if k != "spark.ui.enabled":
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's value always wins.  ``fallback`` is used only when the
    setting is absent (local tests); it is then registered with the
    SparkContext so that ``DataFrame.checkpoint()`` writes there.
    """
    current = None
    try:
        current = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    except Exception:  # noqa: BLE001 - no SparkContext (e.g. Spark Connect)
        pass
    if not current:
        try:
            current = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            current = None
    if current:
        _set_context_dir(spark, current)
        return current
    if fallback is None:
        raise RuntimeError("spark.checkpoint.dir is not set and no fallback was given")
    os.makedirs(fallback, exist_ok=True)
    _set_context_dir(spark, fallback)
    try:
        spark.conf.set("spark.checkpoint.dir", fallback)
    except Exception:  # noqa: BLE001 - static conf in some deployments
        pass
    return fallback


def _set_context_dir(spark: SparkSession, path: str) -> None:
    try:
        spark.sparkContext.setCheckpointDir(path)
    except Exception:  # noqa: BLE001 - no SparkContext (Spark Connect): conf only
        pass


def scale_conf(
    input_bytes: int, target_partition_bytes: int = 256 << 20, cores: int | None = None, most: int | None = None
) -> dict[str, str]:
    """Settings for a large run, derived from the input volume.

    Shuffle partitions ~ input / 256 MB (at least 2x the cores); AQE then
    coalesces small partitions and splits skewed ones at runtime, so the
    number is an upper bound, not a guess to tune per query.  ``most`` caps
    it where the driver's memory for map x reduce statuses asks for that.
    """
    parts = max(int(input_bytes // target_partition_bytes), 2 * (cores or 1), 1)
    parts = min(parts, most) if most else parts
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``curatio`` importable in the executors' Python workers.

    The grouped numpy transforms (``applyInPandas``) run library functions on
    the executors; this zips the package once per application and adds it
    with ``addPyFile`` (``addArtifacts`` on Spark Connect) - the programmatic
    form of ``--py-files``.  Idempotent.
    """
    try:
        app = spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - Spark Connect
        app = str(id(spark))
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="curatio-pyfiles-"), "curatio.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    try:
        spark.sparkContext.addPyFile(out)
    except Exception:  # noqa: BLE001 - Spark Connect
        spark.addArtifacts(out, pyfile=True)
    _SHIPPED.add(app)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (never local)."""
    return df.checkpoint(eager=True)


def scratch(spark: SparkSession, stem: str) -> str:
    """A new path in the shared checkpoint folder; only where none is configured (tests) in a temporary one."""
    base = checkpoint_dir(spark, fallback=os.path.join(tempfile.gettempdir(), "curatio-scratch"))
    return f"{base.rstrip('/')}/{stem}-{uuid.uuid4().hex}"


def written(df: DataFrame, stem: str = "part") -> DataFrame:
    """``df`` written as Parquet into the shared folder and reread: evaluated once, its files survive lost executors.

    Unlike a checkpoint the result is columnar, so each later use reads only
    the columns it needs.
    """
    path = scratch(df.sparkSession, stem)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, by: Sequence[str], stem: str = "part", placed: bool = False) -> DataFrame:
    """``df`` written once into the shared folder, the rows of one ``by`` in one bucket, and reread as a table.

    Readers know the buckets: windows, aggregates and joins by ``by``, with or
    without further columns, need no shuffle, however many results read the
    table.  ``placed``: ``df`` has the rows of one ``by`` in one partition already.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"curatio_{stem}_{uuid.uuid4().hex}"
    d = df if placed else df.repartition(n, *[F.col(f"`{k}`") for k in by])
    d.write.bucketBy(n, *by).option("path", scratch(spark, stem)).format("parquet").saveAsTable(name)
    return spark.table(name)
