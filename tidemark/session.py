"""Session settings and shared folders."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import urlparse

from pyspark.sql import SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}

#: What one task of a query on tables takes in: Spark's own sizes (128, 64 and 256 MB) hold
#: millions of narrow rows, whose sorts and hash tables are many times the bytes read.
TASK_SETTINGS = {
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32m",
}
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_INPUT_PER_PARTITION = 2 << 20
_MOST_PARTITIONS = 2000
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_SCRATCH: list[tuple[SparkSession, str]] = []


def tune(spark: SparkSession) -> SparkSession:
    """Runtime settings every job relies on.

    Skewed partitions of a sort-merge join are split at run time, also where a
    later step would like the old partitioning back: one more exchange costs
    less than one task with a third of the rows.  Arrow batches are small: with long
    texts each stands in memory several times, in the JVM and in the worker.
    """
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    spark.conf.unset(_INITIAL)
    return spark


def size_tasks(spark: SparkSession, input_bytes: int) -> None:
    """Settings that keep a task's share of a query on tables the same whatever the size of its input.

    Shuffles start with a partition for each 2 MB of input, but no fewer than the session's
    and no more than 2,000; what is small is put together at run time.
    """
    for key, value in TASK_SETTINGS.items():
        spark.conf.set(key, value)
    wanted = min(input_bytes // _INPUT_PER_PARTITION, _MOST_PARTITIONS)
    if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(_INITIAL, str(wanted))
    else:
        spark.conf.unset(_INITIAL)


def shuffle_partitions(spark: SparkSession) -> int:
    """Partitions that shuffles start with."""
    return int(spark.conf.get(_INITIAL, None) or spark.conf.get("spark.sql.shuffle.partitions"))


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside leave no shuffle files behind; otherwise these stay until the driver's garbage is collected.

    Only for what runs once: a frame executed again would compute its shuffles anew.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors see, named by ``spark.checkpoint.dir``.

    Only a local session without the setting gets one of its own, below the folder for
    temporary files and named after the application; it is removed with the session.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    path = os.path.join(tempfile.gettempdir(), f"spark-{spark.sparkContext.applicationId}")
    _remove_at_exit(spark, path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; what is written there is removed when the driver ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _remove_at_exit(spark, path)
    return path


def _remove_at_exit(spark: SparkSession, path: str) -> None:
    if not any(p == path for _, p in _SCRATCH):
        _SCRATCH.append((spark, path))


@atexit.register
def remove_scratch() -> None:
    """Remove what scratch paths hold, on whatever store they are; a session that has ended leaves its files."""
    while _SCRATCH:
        spark, path = _SCRATCH.pop()
        try:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        except Exception:  # the JVM may be gone
            if not urlparse(path).scheme:
                shutil.rmtree(path, ignore_errors=True)


def local_session(cores: int | str = "*", memory: str = "8g", partitions: int = 8) -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidemark")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)
