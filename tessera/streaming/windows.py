"""Event-time streaming operators: the same functions serve batch and stream frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.relational import _new, _quoted


def read_stream(spark: SparkSession, folder: str, name: str, files_per_trigger: int = 1) -> DataFrame:
    """A table's Parquet files as a stream, with the schema of the batch table."""
    path = f"{folder.rstrip('/')}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def tumbling_counts(events: DataFrame, ts: str, every: str, late: str, *keys: str) -> DataFrame:
    """Count and sum of value per window and keys; rows later than `late` behind are dropped in a stream."""
    w = _new("w", events)
    timed = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    return (
        timed.groupBy(F.window(ts, every).alias(w), *keys)
        .agg(F.count("*").alias("n"), F.sum("value").alias("total"))
        .select(F.col(f"{w}.start").alias("start"), *keys, "n", "total")
    )


def session_counts(events: DataFrame, ts: str, gap: str, late: str, *keys: str) -> DataFrame:
    """Rows per session window of each key."""
    w = _new("w", events)
    timed = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    return (
        timed.groupBy(F.session_window(ts, gap).alias(w), *keys)
        .agg(F.count("*").alias("n"))
        .select(F.col(f"{w}.start").alias("start"), F.col(f"{w}.end").alias("until"), *keys, "n")
    )


def first_seen(events: DataFrame, ts: str, late: str, *keys: str) -> DataFrame:
    """One row of each combination of keys. A batch gives the row with the least time (rows without a time come last,
    of equal times any one). A stream gives the row that comes first, as it cannot wait for an earlier one; the
    state of a key goes when the watermark has passed its row by `late`, and later rows begin anew."""
    timed = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    if events.isStreaming:
        return timed.dropDuplicatesWithinWatermark([*keys])
    row = _new("row", events)
    first = timed.groupBy(*map(_quoted, keys)).agg(F.min_by(F.struct(*map(_quoted, timed.columns)), F.struct(_quoted(ts).isNull(), _quoted(ts))).alias(row))
    return first.select(f"{row}.*")


def interval_join(a: DataFrame, b: DataFrame, ts: str, late: str, within: str, *keys: str) -> DataFrame:
    """Pairs of rows a, b (columns `a.*` and `b.*`) of equal keys where b comes at the time of a or less than
    `within` later. Watermarks and the time range let a stream drop the rows that can no longer match.
    Null keys and times match nothing."""
    x, y = (d.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late).alias(n) for d, n in ((a, "a"), (b, "b")))
    on = (F.col(f"b.{ts}") >= F.col(f"a.{ts}")) & (F.col(f"b.{ts}") < F.col(f"a.{ts}") + F.expr(f"INTERVAL {within}"))
    for k in keys:
        on = on & (F.col(f"a.{k}") == F.col(f"b.{k}"))
    return x.join(y, on)


def run_to_end(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Drains what is there into Parquet, with exactly-once file commits."""
    q = df.writeStream.outputMode(mode).format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    q.trigger(availableNow=True).start().awaitTermination()
