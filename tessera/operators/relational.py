"""Relational operators that need more than one built-in call.

All are compositions of DataFrame operations, so pushdown, pruning and adaptive
re-planning stay with Catalyst. Columns that an operator adds must be new names; those it needs inside
cannot clash with the frames' own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, NumericType, StringType, TimestampNTZType, TimestampType


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _new(name: str, *frames: DataFrame) -> str:
    """name, with as many underscores before it as make it new in all frames."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def _must_be_new(names: Sequence[str], *frames: DataFrame) -> None:
    taken = {c.lower() for df in frames for c in df.columns}
    if clash := [n for n in names if n.lower() in taken]:
        raise ValueError(f"columns {clash} are there already")


def top_k_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, out: str = "rn") -> DataFrame:
    """The first k rows of each group, with their number in `out`; Spark turns the filter into a
    WindowGroupLimit, so a hot group is cut to k rows before the shuffle. Null keys are a group."""
    _must_be_new([out], df)
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(out, F.row_number().over(w).cast("long")).filter(F.col(out) <= k)


def latest_by(df: DataFrame, by: Sequence[str], order: Column) -> DataFrame:
    """One row per key, the one with the greatest `order`, null last. max_by combines before the shuffle (in a
    sort-based aggregate, as it holds a row), so a hot key is a row a task, not a window."""
    rest = [c for c in df.columns if c not in by]
    held = _new("_best", df)
    rank = F.struct(order.isNotNull(), order)
    best = df.groupBy(*map(_quoted, by)).agg(F.max_by(F.struct(*map(_quoted, rest)), rank).alias(held))
    return best.select(*map(_quoted, by), *[F.col(held).getField(c).alias(c) for c in rest]).select(*map(_quoted, df.columns))


#: Most hot keys that are sent to every task, a hundred bytes or so each; more are joined by a shuffle.
HOT_KEYS = 10_000


def _hot_keys(df: DataFrame, keys: Sequence[str], hot: int) -> DataFrame | None:
    """The keys with more than `hot` rows, counted before the shuffle, or None if there is none. HOT_KEYS of them
    are looked at on the driver at most, and broadcast."""
    many = df.groupBy(*map(_quoted, keys)).agg(F.count("*").alias("_n")).filter(F.col("_n") > hot).drop("_n")
    found = many.limit(HOT_KEYS + 1).collect()
    if not found:
        return None
    return many if len(found) > HOT_KEYS else F.broadcast(df.sparkSession.createDataFrame(found, many.schema))


def _marked(df: DataFrame, many: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """df with `flag` true in the rows of the keys of `many`, else null; null keys count as keys."""
    names = [f"_h{i}" for i in range(len(keys))]
    hot = many.select(*[_quoted(k).alias(n) for k, n in zip(keys, names)], F.lit(True).alias("_is_hot"))
    same = F.lit(True)
    for k, n in zip(keys, names):
        same = same & F.col(f"d.`{k}`").eqNullSafe(F.col(f"h.{n}"))
    joined = df.alias("d").join(hot.alias("h"), same, "left")
    return joined.select(*[F.col(f"d.`{c}`") for c in df.columns], F.col("h._is_hot").alias(flag))


#: Rows that a task takes of a shuffle whose partitions are set by their number.
ROWS = 250_000


def parts_of(*frames: DataFrame) -> int:
    """How many partitions hold at most about ROWS rows each of all frames together, which are counted. Adaptive execution joins
    partitions by their compressed bytes, and of rows that compress well a task would get any number."""
    return max(1, -(-sum(df.count() for df in frames) // ROWS))


def micros(at: Column, kind: DataType) -> Column:
    """Microseconds of a time as a long, whatever its type; those of a time without a zone do not depend on the
    session's zone."""
    if isinstance(kind, TimestampNTZType):
        seconds = (at - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")).cast("interval second").cast("decimal(20,6)")
        return (seconds * 1_000_000).cast("long")
    if isinstance(kind, DateType):
        return F.unix_date(at).cast("long") * 86_400_000_000
    if isinstance(kind, (TimestampType, StringType)):
        return F.unix_micros(at.cast("timestamp"))
    raise ValueError(f"{kind.simpleString()} is not a time")


def _number(at: Column, kind: DataType) -> Column:
    """A double that rises with a number or a time; times in seconds."""
    return at.cast("double") if isinstance(kind, NumericType) else micros(at, kind) / F.lit(1e6)


def asof_join(
    left: DataFrame, right: DataFrame, by: Sequence[str], left_on: str, right_on: str, take: Sequence[str], bucket: Column | None = None, hot: int = 1_000_000
) -> DataFrame:
    """Backward as-of join: each left row gets the columns `take` of the last right row with the
    same key and right_on <= left_on (null if there is none).

    The two sides are unioned and a window carries the last right row forward: no range join. Equal times
    match; among right rows of one time the greatest `take` wins. Right rows without a key or time match nothing, left
    rows without one get nulls and take no part. `bucket`, a rising function of the time column `_t` such as
    F.date_trunc("day", "_t"), splits the rows of keys with more than `hot` rows: their windows are by key
    and bucket, and what a bucket hands on is joined from one row a bucket. All other keys stay whole.
    """
    _must_be_new(take, left)
    keys = [f"_k{i}" for i in range(len(by))]
    known = _quoted(left_on).isNotNull()
    for c in by:
        known = known & _quoted(c).isNotNull()
    own = F.struct(*map(_quoted, left.columns)).alias("_l")
    l = left.filter(known).select(*[_quoted(c).alias(k) for k, c in zip(keys, by)], _quoted(left_on).alias("_t"), F.lit(1).alias("_side"), own)
    r = right.select(*[_quoted(c).alias(k) for k, c in zip(keys, by)], _quoted(right_on).alias("_t"), F.struct(*[_quoted(c).alias(f"v{i}") for i, c in enumerate(take)]).alias("_r"))
    r = r.dropna(subset=[*keys, "_t"]).groupBy(*keys, "_t").agg(F.max("_r").alias("_r")).withColumn("_side", F.lit(0))
    both = l.unionByName(r, allowMissingColumns=True)
    many = None if bucket is None else _hot_keys(both, keys, hot)
    parts = keys
    if many is not None:
        both = _marked(both, many, keys, "_hot").withColumn("_b", F.when(F.col("_hot"), bucket))
        parts = [*keys, "_b"]
    w = Window.partitionBy(*parts).orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    carried = both.withColumn("_r", F.last("_r", ignorenulls=True).over(w)).filter("_side = 1")
    if many is not None:
        ends = both.filter("_hot").groupBy(*parts).agg(F.max_by("_r", F.when(F.col("_side") == 0, F.col("_t"))).alias("_e"))
        before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
        ends = ends.select(*parts, F.last("_e", ignorenulls=True).over(before).alias("_before"))
        carried = carried.join(ends, parts, "left").withColumn("_r", F.coalesce("_r", "_before"))
    found = carried.select("_l.*", *[F.col(f"_r.v{i}").alias(c) for i, c in enumerate(take)])
    none = [F.lit(None).cast(right.schema[c].dataType).alias(c) for c in take]
    return found.unionAll(left.filter(~known).select(*map(_quoted, left.columns), *none))


#: The level of spans without an end, and the parts into which the points that meet them are dealt.
ENDLESS, PARTS = -1, 32


def _level(unit: float) -> Column:
    """The dyadic level of the span (lo, hi): its cells, (unit, 2 unit, 4 unit, ...), are as wide as the span."""
    size = F.greatest(F.col("hi") - F.col("lo"), F.lit(float(unit)))
    ends = F.abs("hi") < float("inf")
    return F.when(ends & (F.abs("lo") < float("inf")) & (size < float("inf")), F.ceil(F.log2(size / unit) - 1e-9).cast("int")).otherwise(ENDLESS)


def _stab(points: DataFrame, spans: DataFrame, keys: Sequence[str], unit: float, inside: Column) -> DataFrame:
    """Points (keys, x, ...) joined with the spans (keys, lo, hi, ...) whose cells hold them, where `inside` is true.

    A span belongs to the dyadic level whose cells (unit, 2 unit, 4 unit, ...) are as wide as itself, so it lies in
    two of them or three at most. A point lies in one cell of each level that has spans; which these are is a scalar
    subquery, a number for each doubling of width. Endless spans are copied to PARTS cells, to which points are dealt.
    """
    cell = lambda x: F.floor(x / (F.lit(float(unit)) * F.pow(F.lit(2.0), F.col("_level"))))
    spans = spans.withColumn("_level", _level(unit))
    levels = spans.agg(F.collect_set("_level")).scalar()
    whole = F.sequence(F.lit(0).cast("long"), F.lit(PARTS - 1).cast("long"))
    spans = spans.withColumn("_cell", F.explode(F.when(F.col("_level") == ENDLESS, whole).otherwise(F.sequence(cell(F.col("lo")), cell(F.col("hi"))))))
    part = F.pmod(F.xxhash64("x") + F.spark_partition_id(), F.lit(PARTS))
    points = points.withColumn("_level", F.explode(levels))
    points = points.withColumn("_cell", F.when(F.col("_level") == ENDLESS, part).when(F.abs("x") < float("inf"), cell(F.col("x"))))
    return points.join(spans, [*keys, "_level", "_cell"]).filter(inside)


def range_join(left: DataFrame, right: DataFrame, by: Sequence[str], point: str, low: str, high: str, width: float) -> DataFrame:
    """Rows with low <= point < high per key: an equi-join on (key, level, cell) that adaptive execution
    can split, not a nested loop. Points and bounds are numbers or times; `width`, in seconds for times, is that
    of the smallest cells.

    Spans that are empty or have a null or NaN end match nothing; those with an infinite end meet all points of their
    key. The columns are those of a join on `by`: keys once, then the other columns of left and right.
    """
    keys = [f"_k{i}" for i in range(len(by))]
    kind = {c: df.schema[c].dataType for df, c in ((left, point), (right, low), (right, high))}
    lo, hi = _number(_quoted(low), kind[low]), _number(_quoted(high), kind[high])
    spans = right.filter((_quoted(high) > _quoted(low)) & ~F.isnan(hi) & ~F.isnan(lo))
    spans = spans.select(*[_quoted(c).alias(k) for k, c in zip(keys, by)], lo.alias("lo"), hi.alias("hi"), F.struct(*map(_quoted, right.columns)).alias("_r"))
    points = left.select(*[_quoted(c).alias(k) for k, c in zip(keys, by)], _number(_quoted(point), left.schema[point].dataType).alias("x"), F.struct(*map(_quoted, left.columns)).alias("_l"))
    at = F.col(f"_l.`{point}`")
    joined = _stab(points, spans, keys, width, (at >= F.col(f"_r.`{low}`")) & (at < F.col(f"_r.`{high}`")))
    rest = [F.col(f"{side}.`{c}`") for side, df in (("_l", left), ("_r", right)) for c in df.columns if c not in by]
    return joined.select(*[F.col(f"_l.`{c}`") for c in by], *rest)


def overlap_join(
    left: DataFrame, right: DataFrame, by: Sequence[str], left_span: tuple[str, str], right_span: tuple[str, str], unit: float, open_ended: bool = False
) -> DataFrame:
    """Pairs (l, r), structs of the columns of left and right, of equal keys whose spans [start, end) overlap.

    The later of two starts lies in both spans. So every pair is found once, in the cell of its later start at the
    greater of its two levels, by one equi-join on (key, level, cell), and nothing is made distinct afterwards. A row
    stands in its cells of its own level, if the other side has spans of that level or a lower one, and of those
    higher levels that the other side has: at most three cells of each. Endless spans are copied to PARTS cells, to
    which the rows of the other side are dealt.

    Bounds are numbers or times, of one type on both sides; `unit`, in seconds for times, is the width of the smallest
    cells. Empty spans, null keys and NaN match nothing. A null bound matches nothing either, or, if
    `open_ended`, is endless; infinite numbers are endless too. No `by` is one key.
    """
    sides = []
    keys = [f"_k{i}" for i in range(len(by))]
    for df, (start, end), name in ((left, left_span, "l"), (right, right_span, "r")):
        a, b = _quoted(start), _quoted(end)
        lo, hi = (_number(x, df.schema[c].dataType) for x, c in ((a, start), (b, end)))
        fits = (a < b) & ~F.isnan(lo) & ~F.isnan(hi)
        if open_ended:
            fits = F.when(a.isNull(), b.isNull() | ~F.isnan(hi)).when(b.isNull(), ~F.isnan(lo)).otherwise(fits)
            lo, hi = F.coalesce(lo, F.lit(float("-inf"))), F.coalesce(hi, F.lit(float("inf")))
        span = df.filter(fits).select(*[_quoted(c).alias(k) for k, c in zip(keys, by)], lo.alias("lo"), hi.alias("hi"), F.struct(*map(_quoted, df.columns)).alias(name))
        sides.append(span.withColumn("_own", _level(unit)))
    l, r = (_placed(own, other, unit, endless).drop("lo", "hi", "_own") for own, other, endless in ((sides[0], sides[1], (-1, -2)), (sides[1], sides[0], (-2, -1))))
    a, b, c, d = (F.col(f"{n}.`{x}`") for n, x in (("l", left_span[0]), ("l", left_span[1]), ("r", right_span[0]), ("r", right_span[1])))
    # A null start is before all others, a null end after all; without open_ended there are none.
    within = lambda start, end: start.isNull() | end.isNull() | (start < end)
    later = c.isNull() | (a.isNotNull() & (c <= a))
    l, r = (x.withColumnsRenamed({"_first": f"_first_{n}", "_level_own": f"_at_{n}"}) for x, n in ((l, "l"), (r, "r")))
    here = (F.col("_level") < 0) | ((F.col("_at_l") | F.col("_at_r")) & F.when(later, F.col("_first_l")).otherwise(F.col("_first_r")))
    # Estimates do not see the copies, so a side of any number of rows would be broadcast.
    return l.join(r.hint("merge"), [*keys, "_level", "_cell"]).filter(here & F.when(later, within(a, d)).otherwise(within(c, b))).select("l", "r")


def _placed(spans: DataFrame, other: DataFrame, unit: float, endless: tuple[int, int]) -> DataFrame:
    """The spans in each (_level, _cell) in which they may meet the other side's; _level_own: it is their own level,
    _first: the cell holds their start. `endless`: the levels of this side's endless spans and of the other side's; endless
    pairs meet at -1, so the left side's endless spans do not stand at -2."""
    levels = other.agg(F.collect_set("_own")).scalar()
    own, mine, theirs = F.col("_own"), *endless
    ends = own == ENDLESS
    at = F.array_intersect(levels, F.sequence(own + 1, F.greatest(F.array_max(levels), own + 1)))
    at = F.when(F.arrays_overlap(levels, F.sequence(F.lit(0), own)), F.array_append(at, own)).otherwise(at)
    met = F.array_contains(levels, ENDLESS)
    none = F.array().cast("array<int>")
    dealt = F.when(met & (~ends if theirs == -2 else F.lit(True)), F.array(F.lit(theirs))).otherwise(none)
    at = F.concat(F.when(ends, F.array(F.lit(mine))).otherwise(at), dealt)
    spans = spans.withColumn("_level", F.explode(at))
    cell = lambda x: F.floor(F.col(x) / (F.lit(float(unit)) * F.pow(F.lit(2.0), F.col("_level"))))
    whole = F.sequence(F.lit(0).cast("long"), F.lit(PARTS - 1).cast("long"))
    part = F.pmod(F.xxhash64("lo", "hi") + F.spark_partition_id(), F.lit(PARTS)).cast("long")
    cells = F.when(F.col("_level") == mine, whole).when(F.col("_level") == theirs, F.array(part)).otherwise(F.sequence(cell("lo"), cell("hi")))
    spans = spans.withColumn("_cell", F.explode(cells))
    return spans.withColumns({"_level_own": F.col("_level") == own, "_first": F.coalesce(F.col("_cell") == cell("lo"), F.lit(False))})


def sessionize(
    df: DataFrame, by: Sequence[str], ts: str, gap_seconds: float, out: str = "session", bucket: Column | None = None, hot: int = 1_000_000
) -> DataFrame:
    """Adds `out`, counted from 0 per key; a new session starts after a gap of more than gap_seconds, to the
    microsecond. Rows without a time come first and belong to session 0.

    `bucket`, a rising function of the time column such as F.date_trunc("day", ts), splits the rows of keys with more
    than `hot` rows: their windows are by key and bucket, and one row a bucket hands on the last time and the count.
    """
    _must_be_new([out], df)
    at, new, part, flag = (_new(n, df) for n in ("_at", "_new", "_part", "_hot"))
    gap = round(gap_seconds * 1_000_000)
    rows = df.withColumn(at, micros(_quoted(ts), df.schema[ts].dataType))
    many = None if bucket is None else _hot_keys(df, by, hot)
    keys = [*map(_quoted, by)]
    parts = keys
    if many is not None:
        rows = _marked(rows, many, by, flag).withColumn(part, F.when(F.col(flag), bucket))
        parts = [*keys, F.col(part)]
    w = Window.partitionBy(*parts).orderBy(F.col(at).asc_nulls_first())
    started = rows.withColumn(new, F.when(F.col(at) - F.lag(at).over(w) > gap, 1).otherwise(0))
    run = started.withColumn(out, F.sum(new).over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("long"))
    if many is None:
        return run.drop(at, new)
    named = [_quoted(c).alias(f"_k{i}") for i, c in enumerate(by)]
    ends = started.filter(F.col(flag)).groupBy(*named, F.col(part).alias("_p")).agg(F.min(at).alias("_lo"), F.max(at).alias("_hi"), F.sum(new).alias("_n"))
    order = Window.partitionBy(*[f"_k{i}" for i in range(len(by))]).orderBy(F.col("_p").asc_nulls_first())
    # A bucket without a time (the null one) has no last time to hand on.
    first = F.when(F.col("_lo") - F.lag("_hi").over(order) > gap, 1).otherwise(0)
    ends = ends.withColumn("_f", first)
    base = F.coalesce(F.sum(F.col("_n") + F.col("_f")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.col("_f")
    ends = ends.select(*[f"_k{i}" for i in range(len(by))], "_p", base.alias("_base"))
    same = F.col("r." + flag) & F.col("r." + part).eqNullSafe(F.col("e._p"))
    for i, c in enumerate(by):
        same = same & F.col(f"r.`{c}`").eqNullSafe(F.col(f"e._k{i}"))
    joined = run.alias("r").join(ends.alias("e"), same, "left")
    return joined.select(*[F.col(f"r.`{c}`") for c in df.columns], (F.col(f"r.`{out}`") + F.coalesce("e._base", F.lit(0))).cast("long").alias(out))


def salted_join(left: DataFrame, right: DataFrame, by: Sequence[str], hot: int = 1_000_000, salts: int = 32, small: int = 10_000) -> DataFrame:
    """Inner equi-join for keys that hold a great share of the left rows, where adaptive splitting does not
    reach (the join feeds an aggregate on the same key, or its left side is one).

    A right side of at most `small` rows, counted no further than that, is broadcast, and nothing is salted. Else the
    keys with more than `hot` left rows are counted. Their left rows are dealt to `salts` parts by a hash of the
    row and the number of its partition, so that equal rows of different partitions part too and a task that runs
    again deals them alike; their right rows are copied to each part. All other rows have part 0, so
    nothing else is copied. Null keys match nothing.
    """
    if small and right.limit(small + 1).count() <= small:
        return left.join(F.broadcast(right), list(by))
    if (many := _hot_keys(left, by, hot)) is None:
        return left.join(right, list(by))
    salt, flag = _new("_salt", left, right), _new("_hot", left, right)
    deal = F.pmod(F.xxhash64(*map(_quoted, left.columns)) + F.spark_partition_id(), F.lit(salts)).cast("int")
    copied = F.when(F.col(flag), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    l = _marked(left, many, by, flag).withColumn(salt, F.when(F.col(flag), deal).otherwise(0)).drop(flag)
    r = _marked(right, many, by, flag).withColumn(salt, F.explode(copied)).drop(flag)
    return l.join(r.hint("merge"), [*by, salt]).drop(salt)
