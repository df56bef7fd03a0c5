"""Exact quantiles and heavy hitters of groups that may be of any size.

Both narrow down by aggregates that combine before the shuffle: nothing is sorted by value over all rows, nothing
is gathered in a list, and a hot group costs a bounded number of rows a task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, ShortType, TimestampNTZType, TimestampType

from tessera.operators.relational import _quoted, micros
from tessera.operators.stored import stored

#: Cells of a bracket in one pass.
CELLS = 1024
#: Most rows left in a bracket for it to be finished by its distinct values.
FINISH = 4096
#: Most brackets that are broadcast, some 100 bytes each; more are joined by a salted shuffle.
BRACKETS, SALTS = 200_000, 32
#: Doubles have magnitudes 2^-1074 to 2^1024.
_SPAN = 1100.0


def _scaled(v: Column) -> Column:
    """A double that does not fall as v rises, with about equal steps for equal ratios; infinities and NaN last."""
    size = F.log2(F.abs(v)) + _SPAN
    plain = F.when(v == 0, F.lit(0.0)).when(v > 0, size).otherwise(-size)
    return F.when(F.isnan(v), 2 * _SPAN + 1).when(v == float("inf"), 2 * _SPAN).when(v == float("-inf"), -2 * _SPAN).otherwise(plain)


def _cell(v: Column, lo: Column, hi: Column, even: bool) -> Column:
    """The cell of v in [lo, hi], 0 to CELLS - 1: a function that does not fall, 0 at lo and CELLS - 1 at hi. Cells are
    of equal width where `even` and the bracket is finite, else of equal ratio; the two in turn narrow any range."""
    ratio = (_scaled(v) - _scaled(lo)) / F.nullif(_scaled(hi) - _scaled(lo), F.lit(0.0))
    if even:
        wide = (F.abs(lo) < 1e300) & (F.abs(hi) < 1e300)
        part = F.when(wide, (v - lo) / F.nullif(hi - lo, F.lit(0.0))).otherwise(ratio)
    else:
        part = ratio
    inner = F.least(F.lit(CELLS - 2), F.greatest(F.lit(0), F.floor(part * CELLS).cast("int")))
    # Where rounding makes the ends of the scale one, all between them is in the cells of its ends.
    return F.when(v == hi, CELLS - 1).when(v == lo, 0).otherwise(F.coalesce(inner, F.lit(0)))


def _rank(q: Column, n: Column) -> Column:
    """The place, from 1, of a discrete quantile among n values."""
    return F.greatest(F.lit(1).cast("long"), n - F.floor(n - q * n))


def quantiles(df: DataFrame, by: Sequence[str], value: str, qs: Sequence[float], finish: int = FINISH, broadcast: int = BRACKETS) -> DataFrame:
    """(by..., q, n, value): the discrete quantiles of each group, values that occur: the least one with at least the
    share q of the group's rows at or below it. n counts the group's values.

    A first aggregate counts each group and finds its ends, the first bracket of each of its quantiles. Each pass then
    counts the rows of a bracket by CELLS cells and keeps the cell that the quantile is in, with the cell's least and
    greatest value as the next bracket. A bracket with no more than `finish` rows, or of one value, is done: the
    former by counts of its distinct values. Brackets are broadcast if
    they are `broadcast` at most, else a shuffle joins them with the rows, large groups dealt to SALTS parts. There are
    some ten passes at most, as each cuts the ratio of a bracket's ends, or the bracket, by a thousand.

    Nulls are left out, so a group of nulls has no row; a null key is a group; NaN is above all numbers, -0.0 is 0.0.
    Values are integers, floats, doubles, decimals of up to 15 digits, dates and timestamps; others raise.
    """
    if not qs or any(not 0 <= q <= 1 for q in qs):
        raise ValueError("shares from 0 to 1 are asked for")
    kind = df.schema[value].dataType
    if not (isinstance(kind, (ByteType, ShortType, IntegerType, LongType, FloatType, DoubleType, DateType, TimestampType, TimestampNTZType)) or isinstance(kind, DecimalType) and kind.precision <= 15):
        raise ValueError(f"no quantiles of {kind.simpleString()}")
    keys = [f"_k{i}" for i in range(len(by))]
    at = _quoted(value)
    number = micros(at, kind).cast("double") if isinstance(kind, (DateType, TimestampType, TimestampNTZType)) else at.cast("double")
    rows = df.filter(at.isNotNull()).select(*[_quoted(c).alias(k) for c, k in zip(by, keys)], number.alias("_x"), at.alias("_v"))
    ends = [F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.min("_x").alias("_xlo"), F.max("_x").alias("_xhi")]
    shares = F.explode(F.array(*[F.lit(float(q)) for q in dict.fromkeys(qs)])).alias("q")
    whole = rows.groupBy(*keys).agg(F.count("*").alias("n"), *ends).filter("n > 0")
    # rank: the place among the values of the bracket; left: how many these are.
    whole = whole.select(*keys, "n", "_lo", "_hi", "_xlo", "_xhi", shares).withColumn("rank", _rank(F.col("q"), F.col("n"))).withColumn("left", F.col("n"))
    flat = F.col("_lo").eqNullSafe(F.col("_hi"))
    short = (F.col("left") <= finish) | (F.col("_xlo") == F.col("_xhi"))
    brackets, done, steps = stored(whole), [], 0
    while True:
        done.append(brackets.filter(flat).select(*keys, "q", "n", F.col("_lo").alias("_v")))
        few, wide = brackets.filter(~flat & short), brackets.filter(~flat & ~short)
        if few.limit(1).count():
            done.append(_finished(_within(rows, few, keys, broadcast, 1), keys))
        if not wide.limit(1).count():
            break
        brackets = stored(_narrowed(_within(rows, wide, keys, broadcast, SALTS), keys, steps % 2 == 0))
        steps += 1
    out = done[0]
    for more in done[1:]:
        out = out.unionAll(more)
    return out.select(*[F.col(k).alias(c) for k, c in zip(keys, by)], "q", "n", F.col("_v").alias(value))


def _within(rows: DataFrame, brackets: DataFrame, keys: list[str], broadcast: int, salts: int) -> DataFrame:
    """Each bracket with the rows that lie in it."""
    small = brackets.limit(broadcast + 1).count() <= broadcast
    brackets = brackets.select(*[F.col(k).alias(f"b{k}") for k in keys], "q", "n", "rank", "_lo", "_hi", "_xlo", "_xhi")
    on = (F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi"))
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"b{k}"))
    if small:
        return rows.join(F.broadcast(brackets), on)
    if salts > 1:  # a group's rows are dealt to parts, its few brackets copied to each
        rows = rows.withColumn("_s", F.pmod(F.xxhash64("_x") + F.spark_partition_id(), F.lit(salts)).cast("int"))
        brackets = brackets.withColumn("_t", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        on = on & (F.col("_s") == F.col("_t"))
    return rows.join(brackets, on)


def _narrowed(rows: DataFrame, keys: list[str], even: bool) -> DataFrame:
    """The next brackets: the cell of each that holds its rank."""
    cell = _cell(F.col("_x"), F.col("_xlo"), F.col("_xhi"), even).alias("cell")
    ends = [F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.min("_x").alias("_xlo"), F.max("_x").alias("_xhi")]
    counts = rows.groupBy(*keys, "q", "n", "rank", cell).agg(F.count("*").alias("left"), *ends)
    # CELLS rows of a bracket at most.
    so_far = F.sum("left").over(Window.partitionBy(*keys, "q").orderBy("cell"))
    counts = counts.withColumn("before", so_far - F.col("left"))
    hit = counts.filter((F.col("before") < F.col("rank")) & (F.col("rank") <= F.col("before") + F.col("left")))
    return hit.select(*keys, "n", "_lo", "_hi", "_xlo", "_xhi", "q", (F.col("rank") - F.col("before")).alias("rank"), "left")


def _finished(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Brackets of few rows: counts of their distinct values, added up in order."""
    counts = rows.groupBy(*keys, "q", "n", "rank", "_v").agg(F.count("*").alias("m"))
    before = F.sum("m").over(Window.partitionBy(*keys, "q").orderBy("_v")) - F.col("m")
    counts = counts.withColumn("before", before)
    return counts.filter((F.col("before") < F.col("rank")) & (F.col("rank") <= F.col("before") + F.col("m"))).select(*keys, "q", "n", "_v")


#: Values that are counted together, and counters that a task holds for each that it gives out.
TOGETHER, HELD = 200_000, 20


def _summaries(size: int):
    """A function of batches of items: counters of the items of a task, `size` at most, and what they may lack.

    The counters of Misra and Gries, many values at a time: counts are added, and if more than HELD * size items have one,
    all lose the next greatest count and those at or below 0 go; at the end the same leaves `size`. What an item
    may lack is the sum of these losses. A row without an item has the losses and the number of nulls."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        lost = rows = nulls = 0
        item = pa.string()

        def cut(most: int) -> None:
            nonlocal held, lost
            if len(held) > most:
                least = sorted(held.values(), reverse=True)[most]
                held = {k: v - least for k, v in held.items() if v > least}
                lost += least

        def add(columns: list[pa.Array]) -> None:
            found = pa.chunked_array(columns).value_counts()
            for k, n in zip(found.field(0).to_pylist(), found.field(1).to_pylist()):
                held[k] = held.get(k, 0) + n
            cut(HELD * size)

        waiting, n = [], 0
        for batch in batches:
            item = batch.schema.field(0).type
            rows += batch.num_rows
            nulls += batch.column(0).null_count
            waiting.append(batch.column(0).drop_null())
            n += batch.num_rows
            if n >= TOGETHER:
                add(waiting)
                waiting, n = [], 0
        if waiting:
            add(waiting)
        cut(size)
        if rows:
            names = [None, *held]
            yield pa.RecordBatch.from_arrays([pa.array(names, item), pa.array([nulls, *held.values()], pa.int64()), pa.array([lost] + [0] * len(held), pa.int64()), pa.array([False] + [True] * len(held))], ["item", "seen", "lost", "counted"])

    return run


def heavy_hitters(df: DataFrame, item: str, k: int, size: int | None = None) -> DataFrame:
    """(item, n): the k most frequent values of a column with their exact counts, those of the k-th place's count all,
    so that ties are not broken by chance.

    Pass one: each task gives out at most `size` counters (Misra and Gries; 8 k by default, at least 1,000), whatever the
    number of distinct values, and counts nulls. Added up, a value's counters lack no more than the sum of what the tasks lost.
    Values whose counters and that sum reach the k-th greatest sum of counters are the candidates; no other can be
    among the k, as the k-th value has that many rows at least. Pass two counts the candidates exactly. The summaries
    are a row for each counter of a task, and are added up by value; the candidates are broadcast if they are few.
    Where values are so even that the losses hide them, more of them are candidates; results are exact always.

    A null is a value like others. Fewer than k distinct values give them all; no rows give none.
    """
    size = size or max(1000, 8 * k)
    kind = df.schema[item].dataType
    values = df.select(_quoted(item).alias("item"))
    found = values.mapInArrow(_summaries(size), f"item {kind.simpleString()}, seen long, lost long, counted boolean")
    found = stored(found)
    nulls = found.filter("NOT counted").agg(F.sum("seen").alias("n")).filter("n > 0").select(F.lit(None).cast(kind).alias("item"), "n")
    values = values.filter("item IS NOT NULL")
    lost = found.agg(F.coalesce(F.sum("lost"), F.lit(0))).first()[0]
    seen = found.filter("counted").groupBy("item").agg(F.sum("seen").alias("seen"))
    best = seen.orderBy(F.desc("seen")).limit(k).agg(F.count("*"), F.min("seen")).first()
    if lost and (best[0] < k or best[1] <= lost):
        # Even a value without a counter could be among the k: every value is counted.
        exact = values.groupBy("item").agg(F.count("*").alias("n"))
    else:
        least = (best[1] or 0) - lost
        candidates = seen.filter(F.col("seen") >= least).select("item") if best[0] == k else seen.select("item")
        candidates = stored(candidates)
        small = candidates.count() <= BRACKETS
        exact = values.join(F.broadcast(candidates) if small else candidates, "item").groupBy("item").agg(F.count("*").alias("n"))
    exact = stored(exact.unionAll(nulls))
    least = exact.orderBy(F.desc("n")).limit(k).agg(F.min("n")).first()[0]
    return exact.filter(F.col("n") >= F.lit(least or 0)).select(F.col("item").alias(item), "n")
