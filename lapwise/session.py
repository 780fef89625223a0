"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even where that costs a later operator a shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


# Partitions a shuffle begins with where the session names fewer; fewer than 200 are written unsorted.
FIRST_PARTITIONS = 192

# Bytes of files a task reads where the session names no size: stored text is compressed so well that
# Spark's default of 128 MB is tens of millions of rows, which a task would sort on disk.
READ_BYTES = 8 * 1024**2
SPARK_READ_BYTES = 128 * 1024**2

# Rows of a stored file; a file's rows are read by one task where it has one row group.
FILE_ROWS = 1_000_000

# Folders a task writes to at once, before it sorts its rows by folder.
OPEN_FILES = 16

# Paths of the stored frames that go at the end of the innermost `passing` block.
_passing: ContextVar[list[str]] = ContextVar("passing")

# Hex digests, which make up most of the tables' bytes, shrink by this codec and not by the default.
COMPRESSION = "zstd"


def build_session(master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName("lapwise")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the adaptive settings to a session made elsewhere; its time zone is left alone."""
    for key, value in SETTINGS.items():
        if key.startswith("spark.sql.adaptive."):
            spark.conf.set(key, value)
    return spark


def widen(spark: SparkSession) -> SparkSession:
    """Let tasks of scans, shuffles and writes stay small; no own choice is changed.

    Shuffles begin with at least `FIRST_PARTITIONS`, which AQE merges, scans read `READ_BYTES` a task,
    and writes into folders keep files open instead of sorting.  With few partitions a task's sort or
    hash table grows with the input, and is spilled.
    """
    first = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    if spark.conf.get(first, None) is None:
        most = max(FIRST_PARTITIONS, int(spark.conf.get("spark.sql.shuffle.partitions")))
        spark.conf.set(first, str(most))
    read = "spark.sql.files.maxPartitionBytes"
    if spark.conf.get(read).rstrip("bB") == str(SPARK_READ_BYTES):
        spark.conf.set(read, str(READ_BYTES))
    writers = "spark.sql.maxConcurrentOutputFileWriters"
    if spark.conf.get(writers) == "0":
        spark.conf.set(writers, str(OPEN_FILES))
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor sees, as named by ``spark.checkpoint.dir``.

    Only where the session names none (local tests) is one made and recorded, so
    later calls agree on it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="lapwise-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; nothing is created yet."""
    return f"{shared_folder(spark)}/lapwise/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    For a costly frame with several consumers: they scan the written table instead of
    each computing it again, and a lost executor costs a rescan, not the lineage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    if (paths := _passing.get(None)) is not None:
        paths.append(path)
    df.write.options(compression=COMPRESSION, maxRecordsPerFile=FILE_ROWS).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def passing(spark: SparkSession) -> Iterator[list[str]]:
    """What this thread has `stored` within the ``with`` block is deleted at its end.

    For steps that write their outcome: nothing that reads the stored frames may leave the block.
    The block is given their paths, in the order they were stored; one taken off the list stays.
    """
    paths: list[str] = []
    token = _passing.set(paths)
    try:
        yield paths
    finally:
        _passing.reset(token)
        for path in paths:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def release(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files of jobs that are over.

    It does so once the driver's garbage collection has met what refers to them, and by
    itself the driver may collect as late as half an hour after.
    """
    spark.sparkContext._jvm.System.gc()
