"""Session settings and the one place that cuts lineage."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import ExitStack, contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "basketry", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a session in one local process without the setting gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    made = tempfile.mkdtemp(prefix="basketry-")
    spark.sparkContext.setCheckpointDir(made)
    return made


_made: list[str] = []


def shared_path(spark: SparkSession, name: str = "table") -> str:
    """A new folder of its own below the shared folder, for a table that later steps read."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def drop_intermediates(spark: SparkSession) -> int:
    """Deletes the folders ``shared_path`` gave out in this process so far, and returns how many there were.

    Results that still read them can't be computed again; call it once they are written.
    """
    paths, _made[:] = list(_made), []
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    return len(paths)


def settle(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder, so later steps see one fixed result."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint()


@contextmanager
def setting(spark: SparkSession, name: str, value: str | None) -> Iterator[None]:
    """A session setting changed for the duration of the block; ``None`` leaves it alone."""
    before = spark.conf.get(name, None)
    try:
        if value is not None:
            spark.conf.set(name, value)
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def state_partitions(spark: SparkSession, number: int | None):
    """Streams started inside keep their state in ``number`` partitions, for as long as their checkpoint lives.

    Without a number the session's own setting holds.
    """
    return setting(spark, "spark.sql.shuffle.partitions", str(number) if number else None)


#: State in RocksDB: on the executors' disks, with a bounded amount of memory for all stores of an executor together.
#: Counting the rows of a store would read every key before it is written.
_ROCKSDB = "spark.sql.streaming.stateStore.rocksdb"
STATE_ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_ROCKSDB}.boundedMemoryUsage": "true",
    f"{_ROCKSDB}.maxMemoryUsageMB": "256",
    f"{_ROCKSDB}.trackTotalNumberOfRows": "false",
}


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state on disk instead of in the heap of the executors.

    A stream that goes on from a checkpoint keeps the kind of state that it began with.
    """
    with ExitStack() as stack:
        for name, value in STATE_ON_DISK.items():
            stack.enter_context(setting(spark, name, value))
        yield
