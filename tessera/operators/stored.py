"""Small frames between the passes of an operator, stored where every executor can read them."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which all executors share. Where none is set, a local master (tests) gets a
    new one; others raise."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-"))
    return context.getCheckpointDir()


def new_folder(spark: SparkSession, what: str) -> str:
    """A new name in the shared folder; what is put there goes when the session's JVM ends."""
    path = f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}"
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def stored(df: DataFrame) -> DataFrame:
    """df, computed and checkpointed in the shared folder: lineage ends there, and a lost executor costs no pass."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
