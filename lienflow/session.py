"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# AQE picks partition counts and splits skewed joins at run time; dates and times are UTC throughout.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # The JVM never compiles methods above 8000 bytes.  A projection of many text fields can exceed that
    # in whole-stage code; Spark then uses its projection code instead, which is cut into small methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A job's shuffles go at its end: a driver that collects no garbage keeps the files of all of them, and the places
    # of their blocks in its memory.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # Every table that is written and read again is listed once.  The cache would keep the listings of all of them.
    "spark.sql.hive.filesourcePartitionFileCacheSize": "0",
}

_local_folders: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings that results and plans rely on."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "lienflow", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only for a local master."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("name a folder that all executors share in spark.checkpoint.dir")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="lienflow-")
    return _local_folders[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(rows: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared folder and read again: cuts the lineage and outlives lost executors."""
    path = scratch_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
