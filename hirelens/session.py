"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# UTC everywhere: landing dates and event times must not depend on the machine.
# Partition counts are left to adaptive execution, which sizes them from the data.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Keys of an exact stream deduplication are kept on disk, not in memory.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Recording a call site for every Column operation makes building a plan slow.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int | str = "*", **more: str) -> SparkSession:
    """A local session for tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("hirelens")
    local = {"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    for key, value in {**SETTINGS, **local, **more}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _scratch_root(spark: SparkSession) -> str:
    """The folder of this application's stored steps, under ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _local_scratch.setdefault(spark.sparkContext.applicationId, "") or tempfile.mkdtemp(prefix="hirelens-")
        _local_scratch[spark.sparkContext.applicationId] = base
    return f"{base.rstrip('/')}/hirelens/{spark.sparkContext.applicationId}"


_local_scratch: dict[str, str] = {}


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share; it stays until :func:`remove_scratch`."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession) -> None:
    """Remove every step this application has stored, when no result that reads one is needed any more.

    Results are lazy and may read stored steps, so nothing is removed before the caller says so.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows of a scan rehashed over as many tasks as ``spark.hirelens.spread`` says.

    Off by default. A session on one machine that parses a small file, which is one task
    whatever follows it, may set it; it adds an exchange.
    """
    tasks = int(df.sparkSession.conf.get("spark.hirelens.spread", "0"))
    return df.repartition(tasks, key) if tasks else df


@contextmanager
def open_directories(spark: SparkSession, count: int) -> Iterator[None]:
    """Partitioned writes inside keep a file open in each of up to ``count`` directories per task.

    Without it, every task sorts its rows by directory first and spills them. More directories are sorted as ever.
    """
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(count))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


@contextmanager
def shuffle_files_removed(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a query that ends inside go with it.

    Otherwise they stay until the driver collects its garbage, so a job of many steps holds those of all of them.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a result to the shared scratch folder and read it back.

    For a small result of a large scan that several steps read: the scan runs once, and
    a lost executor costs a re-read, not a recomputation.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
