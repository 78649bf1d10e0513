"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_folder: str | None = None


def get_session(app_name: str = "periodlens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library relies on.

    On a cluster leave ``master`` out; size ``spark.sql.shuffle.partitions``
    there to about (largest shuffle in bytes) / 128 MB, AQE merges what is too
    small.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Recording the Python call site of every column doubles the time to build a plan.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder.
    """
    global _local_folder
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="periodlens-")
    return _local_folder


def _pin_root(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/pins-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, removed by ``release_pins``."""
    return f"{_pin_root(spark)}/{label}-{uuid.uuid4().hex}"


def pin(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage so that a lost executor cannot change values that are not
    reproducible on a second run (row positions after a range sort), and lets
    later steps read only the columns they need. It also gives the optimizer
    the true size, so a pinned side of a join is broadcast if and only if it
    is below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_methods(spark: SparkSession) -> Iterator[None]:
    """Inside, what is run is generated as many small methods, without whole-stage code generation.

    A projection of dozens of long expressions otherwise becomes one method
    that is too large for the JVM to compile, and every row is interpreted.
    """
    name = "spark.sql.codegen.wholeStage"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Remove one table or file of this application's scratch folder, once nothing will read it again."""
    if not path.startswith(_pin_root(spark) + "/"):
        raise ValueError(f"not a scratch path: {path}")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def release_pins(spark: SparkSession) -> None:
    """Remove all tables and scratch files of this application. Call after the last action."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_pin_root(spark))
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if files.exists(path):
        files.delete(path, True)
