"""The folder that driver and executors share, for datasets that a job writes and reads again."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; only where that is unset, a folder of one's own (one machine, as in tests)."""
    named = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="cellstream-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    for made in _recording:
        made.append(path)
    return path


_recording: list[list[str]] = []


@contextmanager
def recorded() -> Iterator[list[str]]:
    """The paths that new_path gives meanwhile, in order."""
    made: list[str] = []
    _recording.append(made)
    try:
        yield made
    finally:
        _recording.remove(made)


def _at(spark: SparkSession, path: str) -> tuple:
    """The file system of a path, and the path, of any scheme that Spark reads."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    files, at = _at(spark, path)
    return files.exists(at)


def size(spark: SparkSession, path: str) -> int:
    """Bytes of what lies under a path."""
    files, at = _at(spark, path)
    return files.getContentSummary(at).getLength()


def names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder."""
    files, at = _at(spark, path)
    return sorted(x.getPath().getName() for x in files.listStatus(at))


def delete(spark: SparkSession, paths: list[str]) -> None:
    """Deletes datasets that nothing reads any more."""
    for p in paths:
        files, at = _at(spark, p)
        files.delete(at, True)


_let_go_at = 0.0


def let_go(spark: SparkSession, every: float = 5.0) -> None:
    """Lets Spark delete the shuffle files and checkpoints of jobs that are done, which it does when the driver collects what owned them; once in so many seconds at most."""
    global _let_go_at
    if time.monotonic() - _let_go_at < every:
        return
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    _let_go_at = time.monotonic()
