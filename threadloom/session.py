"""Session helper, shared scratch tables and size-checked broadcasts."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

#: Broadcast only tables that were measured and found to be at most this large.
BROADCAST_MAX_ROWS, BROADCAST_MAX_BYTES = 1_000_000, 64 << 20

_local_dirs: dict[str, str] = {}
_shipped: set[str] = set()


def get_spark(app: str = "threadloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job here relies on."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    base = os.path.join(tempfile.mkdtemp(prefix="threadloom-py-"), "threadloom")
    archive = shutil.make_archive(base, "zip", os.path.dirname(package), os.path.basename(package))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder for cut lineage: ``spark.checkpoint.dir``, or a scratch folder in local mode."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="threadloom-")
    return _local_dirs[context.applicationId]


def materialize(df: DataFrame, label: str, **options) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back; ``options`` are the writer's.

    The result has no lineage, survives lost executors and carries real size statistics, which
    lets the planner choose its joins from facts.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(table: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Hint a broadcast for a stored table of measured size; a larger one keeps the shuffle join.

    Rows are counted, and the bytes of text and array columns summed; other columns count as 8 bytes.
    """
    width = F.lit(8 * len(table.columns))
    for name, kind in table.dtypes:
        if kind in ("string", "binary"):
            width = width + F.coalesce(F.octet_length(name), F.lit(0))
        elif kind.startswith("array"):
            width = width + 8 * F.coalesce(F.size(name), F.lit(0))
    rows, size = table.agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0))).first()
    return F.broadcast(table) if rows <= max_rows and size <= max_bytes else table
