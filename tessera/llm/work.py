"""Shared folder, stored intermediates and size-checked broadcasts."""

from __future__ import annotations

import ctypes
import functools
import gc
import re
import tempfile
import uuid
from collections.abc import Callable
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Most ids that are broadcast, some 100 bytes each in a join's table; beyond it the same join is shuffled.
BROADCAST_IDS = 500_000
#: Bytes of a Parquet row group of intermediates: a writer holds one in memory.
ROW_GROUP = 16 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a new local one only where that is unset and the master is
    local (tests), as executors elsewhere would not see it."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = spark.conf.get("tessera.shared.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="tessera-")
        spark.conf.set("tessera.shared.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark)}/tessera/{what}-{uuid.uuid4().hex}"


def drop_at_exit(spark: SparkSession, path: str) -> None:
    """Has the driver delete a finished intermediate, in whatever store it is, when the session's JVM ends."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)


#: Paths of the intermediates that the innermost settled() has made so far.
_inner: ContextVar[list[str] | None] = ContextVar("inner", default=None)
#: Has Spark drop a query's shuffle files when the query ends.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stash(df: DataFrame, what: str, per_file: int = 0) -> DataFrame:
    """Writes df as Parquet to the shared folder and reads it back: lineage ends there, and a lost
    executor costs no recomputation of what stands before. Its shuffle files go with the write. per_file: most
    rows in a file, for large rows."""
    spark = df.sparkSession
    path = new_path(spark, what)
    before = spark.conf.get(_CLEAN, None)
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.option("compression", "zstd").option("parquet.block.size", ROW_GROUP).option("maxRecordsPerFile", per_file).parquet(path)
    finally:
        spark.conf.unset(_CLEAN) if before is None else spark.conf.set(_CLEAN, before)
    drop_at_exit(spark, path)
    if (paths := _inner.get()) is not None:
        paths.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*stored: DataFrame) -> None:
    """Deletes what stash() has written, once nothing reads it any more."""
    for df in stored:
        _delete(df.sparkSession, df.stored_at)


def _delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def settled(build: Callable[[], DataFrame], spark: SparkSession, what: str) -> DataFrame:
    """What build() returns, stored; the intermediates that it made are deleted, also if it fails."""
    paths: list[str] = []
    outer = _inner.set(paths)
    try:
        out = stash(build(), what)
        done = paths.pop()
    finally:
        _inner.reset(outer)
        for path in paths:
            _delete(spark, path)
    if (outside := _inner.get()) is not None:
        outside.append(done)
    return out


def sized(ids: DataFrame, most: int = BROADCAST_IDS) -> DataFrame:
    """Marks a stored frame for broadcast if it has at most `most` rows; else leaves it to the planner."""
    return F.broadcast(ids) if ids.count() <= most else ids


#: Bytes of an Arrow batch of texts, on their way to Python and back: each task has some of them on either side.
BATCH = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Bounds the bytes of the session's Arrow batches, besides their rows, unless its own bound is lower."""
    found = re.fullmatch(r"(\d+)b?", spark.conf.get(_BATCH))
    if found is None or int(found[1]) > BATCH:
        spark.conf.set(_BATCH, str(BATCH))


@functools.lru_cache(1)
def _trim():
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):  # only the GNU C library has it
        return lambda _: None


#: The functions whose tables a worker keeps from task to task.
_kept: list = []


def kept(most: int):
    """functools.lru_cache for tables that the tasks of one module share; settle() of another module drops them."""

    def keep(f):
        _kept.append(found := functools.lru_cache(most)(f))
        return found

    return keep


def settle(module: str = "") -> None:
    """For a worker at the start of a task: its objects are many and form no cycles, so the collector looks
    through them seldom. Workers are reused: tables that tasks of other modules have kept go."""
    gc.set_threshold(300_000, 50, 100)
    gone = [f for f in _kept if f.__module__ != module and f.cache_info().currsize]
    for f in gone:
        f.cache_clear()
    if gone:
        tidy()


def tidy(*memos: dict) -> None:
    """Empties what a worker remembers and returns freed memory to the system: workers are reused, and a
    later stage would otherwise run beside what an earlier one has left."""
    for memo in memos:
        memo.clear()
    pa.default_memory_pool().release_unused()
    _trim()(0)
