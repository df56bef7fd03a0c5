"""The tables of one folder, read lazily so that Catalyst prunes columns and pushes filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table; any path or store that Spark can read."""
    if name not in NAMES:
        raise ValueError(f"no table {name!r}")
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


class Tables:
    """Attribute access: Tables(spark, folder).orders"""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        found = self.__dict__[name] = table(self._spark, self._folder, name)
        return found
