"""Session defaults for local runs and tests; a cluster's own settings win."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int = 8, shuffle_partitions: int | None = None, driver_memory: str = "8g") -> SparkSession:
    """A local[cores] session with UTC time and adaptive execution."""
    os.environ.setdefault("PYSPARK_SUBMIT_ARGS", f"--driver-memory {driver_memory} pyspark-shell")
    conf = DEFAULTS | {"spark.sql.shuffle.partitions": str(shuffle_partitions or cores)}
    spark = SparkSession.builder.master(f"local[{cores}]").appName("tessera").config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
