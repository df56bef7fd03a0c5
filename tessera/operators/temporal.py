"""Histories: rows that are valid from a start to an end, [start, end).

A null start is the beginning of time, a null end is still open. Rows that end before or when they start are empty and
left out. Starts and ends are numbers, dates or timestamps of one type.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.relational import _hot_keys, _marked, _must_be_new, _quoted, overlap_join, parts_of


def _valid(df: DataFrame, start: str, end: str) -> DataFrame:
    a, b = _quoted(start), _quoted(end)
    return df.filter(a.isNull() | b.isNull() | (a < b))


def coalesce(
    df: DataFrame, by: Sequence[str], start: str, end: str, out: str = "n", bucket: Column | None = None, hot: int = 1_000_000
) -> DataFrame:
    """(by..., start, end, out): for each combination of `by` the longest spans without a gap that its rows cover
    together, with the number of these rows. Rows that overlap or meet are of one span.

    A window by key in the order of the starts carries the greatest end so far; a row that starts behind it begins a
    span. `bucket`, a rising function of the start `_a` such as F.date_trunc("month", "_a"), splits the rows of keys with
    more than `hot` rows: windows are then by key and bucket, and one row a bucket hands on the greatest end and, once
    that is known, the number of spans begun. Rows of one span are added up before they are shuffled, wherever they lie.

    Rows are counted first, and a task of the windows gets about ROWS of them, as keys allow.

    A null in `by` is a value. Ties of starts make no difference.
    """
    _must_be_new([out], df.select(*map(_quoted, by), _quoted(start), _quoted(end)))
    keys = [f"_k{i}" for i in range(len(by))]
    # Ends as (open, end), so that an open one is the greatest.
    rows = _valid(df, start, end).select(*[_quoted(c).alias(k) for k, c in zip(keys, by)], _quoted(start).alias("_a"), F.struct(_quoted(end).isNull().alias("open"), _quoted(end).alias("at")).alias("_z"))
    number = parts_of(rows)
    many = None if bucket is None else _hot_keys(rows, keys, hot)
    parts = keys
    carried = F.lit(None).cast(rows.schema["_z"].dataType)
    if many is not None:
        rows = _marked(rows, many, keys, "_hot").withColumn("_b", F.when(F.col("_hot"), bucket))
        parts = [*keys, "_b"]
        before = Window.partitionBy(*keys).orderBy(F.col("_b").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
        ends = rows.filter("_hot").groupBy(*parts).agg(F.max("_z").alias("_e")).withColumn("_e", F.max("_e").over(before))
        rows = _handed(rows, ends, parts, "_e")
        carried = F.col("_e")
    if parts:
        rows = rows.repartition(number, *parts)
    w = Window.partitionBy(*parts).orderBy(F.col("_a").asc_nulls_first())
    so_far = F.greatest(carried, F.max("_z").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    begins = so_far.isNull() | (F.col("_a").isNotNull() & ~so_far.getField("open") & (F.col("_a") > so_far.getField("at")))
    rows = rows.withColumn("_new", begins.cast("int"))
    rows = rows.withColumn("_span", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    if many is not None:
        begun = rows.filter("_hot").groupBy(*parts).agg(F.sum("_new").alias("_s")).withColumn("_s", F.sum("_s").over(before))
        rows = _handed(rows.drop("_e"), begun, parts, "_s").withColumn("_span", F.col("_span") + F.coalesce("_s", F.lit(0)))
    first = F.min(F.struct(F.col("_a").isNotNull(), F.col("_a").alias("at"))).getField("at")
    spans = rows.groupBy(*keys, "_span").agg(first.alias("_from"), F.max("_z").getField("at").alias("_to"), F.count("*").alias("_n"))
    return spans.select(*[F.col(k).alias(c) for k, c in zip(keys, by)], F.col("_from").alias(start), F.col("_to").alias(end), F.col("_n").alias(out))


def _handed(rows: DataFrame, handed: DataFrame, parts: Sequence[str], name: str) -> DataFrame:
    """rows with the column `name` of their key and bucket; nulls are values, and rows of no bucket get null."""
    on = F.col("r._hot")
    for p in parts:
        on = on & F.col(f"r.{p}").eqNullSafe(F.col(f"h.{p}"))
    return rows.alias("r").join(handed.alias("h"), on, "left").select("r.*", F.col(f"h.{name}"))


def valid_time_join(
    left: DataFrame, right: DataFrame, by: Sequence[str], left_span: tuple[str, str], right_span: tuple[str, str], unit: float, out: tuple[str, str] = ("valid_from", "valid_to")
) -> DataFrame:
    """(l, r, *out): the rows of two histories that hold at the same time, as structs, and since when and until when they
    both do; null where neither history says. `by` are the keys, null matching nothing; `unit`, in seconds for times,
    is the width of the smallest cells of the overlap join that finds the pairs."""
    pairs = overlap_join(left, right, by, left_span, right_span, unit, open_ended=True)
    both = lambda f, k: f(F.col(f"l.`{left_span[k]}`"), F.col(f"r.`{right_span[k]}`"))
    # greatest and least pass over nulls, and are null for two of them.
    return pairs.select("l", "r", both(F.greatest, 0).alias(out[0]), both(F.least, 1).alias(out[1]))
