"""Session helpers: builder defaults, the checkpoint folder and size checks."""

from __future__ import annotations

import gc
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side is broadcast only when its measured size is at most this.
BROADCAST_BYTES = 64 * 1024 * 1024


def build_session(app: str = "martlib", cores: str | int = "*", shuffle_partitions: int | None = None) -> SparkSession:
    """A local session with the settings the library is tuned for.

    On a cluster the caller brings the session; nothing in the library depends
    on this builder.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # call sites of column expressions are recorded for error messages; plans here build thousands
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints, taken from ``spark.checkpoint.dir``.

    A folder of our own is set only for a local master (tests, notebooks); on a
    cluster a missing setting is an error, since a machine-local folder would
    be lost with its executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="martlib-checkpoint-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


# Settings of jobs that write what they make.
JOB_SETTINGS = {
    # Spark removes a job's shuffle files as soon as it has ended. Otherwise they stay until the driver's
    # memory is collected, so a plan of many steps would hold the shuffles of all of them on disk.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # The JVM does not compile methods of more bytes; Spark then generates code by operator, in several methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


@contextmanager
def job_settings(spark: SparkSession) -> Iterator[None]:
    """Frames made and run inside leave no shuffle files and run compiled code, however wide their rows are."""
    before = {key: spark.conf.get(key, None) for key in JOB_SETTINGS}
    for key, value in JOB_SETTINGS.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def free_unused(spark: SparkSession) -> None:
    """Have Spark's cleaner remove shuffles and checkpoints that no frame refers to any more."""
    gc.collect()
    spark._jvm.System.gc()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the checkpoint folder so that several branches can read it."""
    checkpoint_dir(df.sparkSession)
    with job_settings(df.sparkSession):
        return df.select("*").checkpoint()


def cut_in_place(df: DataFrame) -> DataFrame:
    """As ``cut_lineage``, and windows over the result know how its rows are partitioned and sorted.

    Adaptive plans do not tell their partitioning, so this one is planned without;
    ``df`` should be a short plan over written rows.
    """
    conf = df.sparkSession.conf
    adaptive = conf.get("spark.sql.adaptive.enabled")
    conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return cut_lineage(df.select("*"))
    finally:
        conf.set("spark.sql.adaptive.enabled", adaptive)


@contextmanager
def arrow_batches(spark: SparkSession, size: int) -> Iterator[None]:
    """Jobs started inside give Python functions Arrow batches of about ``size`` bytes, however long the rows are."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _row_bytes(df: DataFrame) -> Column:
    """Size of a row in memory, from the text lengths of its columns."""
    size = F.lit(0).cast("long")
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(f.name), F.lit(0)) + 16
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size = size + 2 * F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f.name)))), F.lit(0)) + 16
        else:
            size = size + 16
    return size


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Proves the size of a side before it is broadcast.

    The size is added up in the tasks, so the check moves one row per task
    however large ``df`` is.
    """
    total = df.agg(F.sum(_row_bytes(df))).first()[0]
    return (total or 0) <= max_bytes


def small_side(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint behind a size check; beyond the bound Spark shuffles the join."""
    return F.broadcast(df) if fits_broadcast(df, max_bytes) else df
