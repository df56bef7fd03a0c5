"""Views of joins and aggregates kept up to date from inserts and deletes.

A change is a row with a weight `w`: 1 for an insert, -1 for a delete, k for k of them at once. A join's changes are
those of one side joined with all of the other, with weights multiplied; an aggregate keeps, besides count and sum, how
often each value is there, so that a deleted minimum or maximum has a next one. The batch functions do this with stored
frames, the stream functions with Spark's state store, where a batch costs what it changes.

Rows are multisets: equal rows add up, and a row whose weights add up to 0 is not there. A delete may come before its
insert; in between its weight is negative, which n and total count and lo and hi pass over. A null join key matches nothing, a null group
is a group; null values count in n alone. Values are integers or decimals, as sums of doubles would drift.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from decimal import Decimal

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import DataType, DecimalType, IntegralType, StructType

from tessera.operators.relational import _quoted, latest_by, parts_of
from tessera.streaming.patterns import ROCKS

WEIGHT = "w"
#: Rows go through the state as JSON, which keeps every type and null; times to the microsecond.
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def consolidate(df: DataFrame) -> DataFrame:
    """Each distinct row once, with the sum of its weights; those of sum 0 go."""
    rest = [c for c in df.columns if c != WEIGHT]
    return df.groupBy(*map(_quoted, rest)).agg(F.sum(WEIGHT).alias(WEIGHT)).filter(F.col(WEIGHT) != 0).select(*map(_quoted, df.columns))


def join_changes(left: DataFrame, left_changes: DataFrame, right: DataFrame, right_changes: DataFrame, on: Sequence[str]) -> DataFrame:
    """The changes of left JOIN right on equal `on`: left_changes with right as it is now, and left as it was with
    right_changes. left and right are weighted rows from before the changes; other columns of the two have names of
    their own. All are counted first, and a task of the joins gets about ROWS of their rows."""

    number = parts_of(left, left_changes, right, right_changes)
    dealt = lambda df: df.repartition(number, *map(_quoted, on)) if number > 1 else df

    def pairs(l: DataFrame, r: DataFrame) -> DataFrame:
        l, r = dealt(l), dealt(r)
        both = l.withColumnRenamed(WEIGHT, "_wl").join(r.withColumnRenamed(WEIGHT, "_wr"), list(on))
        return both.withColumn(WEIGHT, F.col("_wl") * F.col("_wr")).drop("_wl", "_wr")

    return pairs(left_changes, right.unionByName(right_changes)).unionByName(pairs(left, right_changes))


def _exact(kind: DataType) -> DecimalType:
    if not isinstance(kind, (IntegralType, DecimalType)):
        raise ValueError(f"values are integers or decimals, not {kind.simpleString()}")
    return DecimalType(38, kind.scale if isinstance(kind, DecimalType) else 0)


def aggregate(rows: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """(by..., n, total, lo, hi) of weighted rows; groups of n = 0 are left out."""
    there = F.col(WEIGHT) > 0
    kind = _exact(rows.schema[value].dataType)
    v = _quoted(value).cast(kind)
    out = consolidate(rows.select(*map(_quoted, by), _quoted(value), WEIGHT)).groupBy(*map(_quoted, by)).agg(
        F.sum(WEIGHT).alias("n"), F.sum(v * F.col(WEIGHT)).cast(kind).alias("total"), F.min(F.when(there, v)).alias("lo"), F.max(F.when(there, v)).alias("hi")
    )
    return out.filter("n <> 0")


def aggregate_changes(rows: DataFrame, changes: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """(by..., n, total, lo, hi) of the groups that the changes touch, as they are after them; n is 0, and the others
    null, where a group has gone. rows are the weighted rows from before: those of touched groups alone are read on."""
    keys = [f"_k{i}" for i in range(len(by))]
    touched = changes.select(*[_quoted(c).alias(k) for c, k in zip(by, keys)]).distinct()
    same = F.lit(True)
    for c, k in zip(by, keys):
        same = same & _quoted(c).eqNullSafe(F.col(k))
    own = [*by, value, WEIGHT]
    old = rows.select(*map(_quoted, own)).join(touched, same, "left_semi")
    now = aggregate(old.unionByName(changes.select(*map(_quoted, own))), by, value)
    out = touched.join(now, same, "left")
    return out.select(*[F.col(k).alias(c) for c, k in zip(by, keys)], F.coalesce("n", F.lit(0).cast("long")).alias("n"), "total", "lo", "hi")


def updated(old: DataFrame, changes: DataFrame, by: Sequence[str]) -> DataFrame:
    """An aggregate as it is after the changes: its untouched groups, and the touched ones that are still there."""
    same = F.lit(True)
    for c in by:
        same = same & F.col(f"o.`{c}`").eqNullSafe(F.col(f"c.`{c}`"))
    return old.alias("o").join(changes.alias("c"), same, "left_anti").unionByName(changes.filter("n <> 0"))


class _Join(StatefulProcessor):
    """The rows of both sides of a join key, with their weights; emits what each change adds and takes away."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.sides = [handle.getMapState(name, "row string", "w long") for name in ("left", "right")]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        came: list[dict[str, int]] = [{}, {}]
        for part in rows:
            for side, row, w in zip(part["side"].tolist(), part["row"].tolist(), part[WEIGHT].tolist()):
                came[side][row] = came[side].get(row, 0) + w
        for side in (0, 1):  # the left changes meet the right as it was, the right ones the left as it is then
            changes = {r: w for r, w in came[side].items() if w}
            if not changes:
                continue
            out = []
            for (other,), (many,) in self.sides[1 - side].iterator():
                out += [((r, other) if side == 0 else (other, r), w * many) for r, w in changes.items()]
                if len(out) > 10_000:
                    yield pd.DataFrame([(*pair, w) for pair, w in out], columns=["l", "r", WEIGHT])
                    out = []
            if out:
                yield pd.DataFrame([(*pair, w) for pair, w in out], columns=["l", "r", WEIGHT])
            held = self.sides[side]
            for r, w in changes.items():
                now = w + (held.getValue((r,))[0] if held.containsKey((r,)) else 0)
                held.updateValue((r,), (now,)) if now else held.removeKey((r,))

    def close(self) -> None:
        pass


class _Aggregate(StatefulProcessor):
    """Count and sum of a group, its extremes, and the weight of each of its values."""

    def __init__(self, keys: list[str]):
        self.keys = keys

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.sums = handle.getValueState("sums", "n long, total string, lo string, hi string")
        self.values = handle.getMapState("values", "v string", "w long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        n, total, *ends = self.sums.get() if self.sums.exists() else (0, "0", None, None)
        total, (lo, hi) = Decimal(total), (None if x is None else Decimal(x) for x in ends)
        came: dict[str, int] = {}
        for part in rows:
            for v, w in zip(part["v"].tolist(), part[WEIGHT].tolist()):
                n += w
                if v is not None:
                    came[v] = came.get(v, 0) + w
        lost = False
        for v, w in came.items():
            if not w:
                continue
            x = Decimal(v)
            before = self.values.getValue((v,))[0] if self.values.containsKey((v,)) else 0
            now, total = before + w, total + x * w
            self.values.updateValue((v,), (now,)) if now else self.values.removeKey((v,))
            if now > 0:
                lo, hi = x if lo is None else min(lo, x), x if hi is None else max(hi, x)
            elif before > 0:
                lost |= x in (lo, hi)
        if lost:  # an extreme has gone: the next is among the values that are there
            there = [Decimal(v) for (v,), (w,) in self.values.iterator() if w > 0]
            lo, hi = min(there, default=None), max(there, default=None)
        said = tuple(None if x is None else format(x, "f") for x in (total, lo, hi))
        if n or next(iter(self.values.iterator()), None) is not None:
            self.sums.update((n, *said))
        else:
            self.sums.clear()
        said = said if n else (None, None, None)
        yield pd.DataFrame([(*key, n, *said)], columns=[*self.keys, "n", "total", "lo", "hi"])

    def close(self) -> None:
        pass


def _store(df: DataFrame) -> None:
    """The state store that such operators need, if it is not set."""
    if df.sparkSession.conf.get("spark.sql.streaming.stateStore.providerClass", "") != ROCKS:
        df.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)


def join_stream(left: DataFrame, right: DataFrame, on: Sequence[str], parts: int = 1) -> DataFrame:
    """The changes of a join of two streams of weighted rows, in append mode: on, the other columns of left, those of right,
    w. A batch reads the other side's rows of the keys that it changes. `parts` deals each key's left rows to so many
    groups and copies its right rows to them, for keys with very many left rows."""
    _store(left)
    keys = [f"_k{i}" for i in range(len(on))]
    rest = [[c for c in df.columns if c not in (*on, WEIGHT)] for df in (left, right)]

    def side(df: DataFrame, which: int) -> DataFrame:
        row = F.to_json(F.struct(*map(_quoted, rest[which])), _JSON) if rest[which] else F.lit("{}")
        out = df.select(*[_quoted(c).alias(k) for c, k in zip(on, keys)], F.lit(which).alias("side"), row.alias("row"), F.col(WEIGHT).cast("long").alias(WEIGHT)).dropna(subset=keys)
        every = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
        return out.withColumn("_part", F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int") if which == 0 else every)

    both = side(left, 0).unionByName(side(right, 1))
    kinds = dict(both.dtypes)
    names = [*keys, "_part"]
    grouped = both.groupBy(*names)
    found = grouped.transformWithStateInPandas(_WithKey(_Join(), names), ", ".join([*(f"{k} {kinds[k]}" for k in names), "l string, r string, w long"]), "append", "none")
    shapes = [StructType([df.schema[c] for c in own]) for df, own in zip((left, right), rest)]
    out = [F.from_json(c, shape, _JSON).alias(c) for c, shape in zip("lr", shapes) if len(shape)]
    found = found.select(*[F.col(k).alias(c) for k, c in zip(keys, on)], *out, WEIGHT)
    return found.select(*map(_quoted, on), *[F.col(f"{n}.`{c}`") for n, own in zip("lr", rest) for c in own], WEIGHT)


class _WithKey(StatefulProcessor):
    """Puts the grouping key before what a processor emits."""

    def __init__(self, inner: StatefulProcessor, names: list[str]):
        self.inner, self.names = inner, names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.inner.init(handle)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for out in self.inner.handleInputRows(key, rows, timerValues):
            for k, name in enumerate(self.names):
                out.insert(k, name, [key[k]] * len(out))
            yield out

    def close(self) -> None:
        pass


def aggregate_stream(changes: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """aggregate_changes() of a stream of weighted rows, in update mode: a row for each group that a batch touches."""
    _store(changes)
    kind = _exact(changes.schema[value].dataType)
    keys = [f"_k{i}" for i in range(len(by))]
    rows = changes.select(*[_quoted(c).alias(k) for c, k in zip(by, keys)], _quoted(value).cast(kind).cast("string").alias("v"), F.col(WEIGHT).cast("long").alias(WEIGHT))
    kinds = dict(rows.dtypes)
    schema = ", ".join([*(f"{k} {kinds[k]}" for k in keys), "n long, total string, lo string, hi string"])
    found = rows.groupBy(*keys).transformWithStateInPandas(_Aggregate(keys), schema, "update", "none")
    return found.select(*[F.col(k).alias(c) for k, c in zip(keys, by)], "n", *[F.col(c).cast(kind).alias(c) for c in ("total", "lo", "hi")])


def keep_view(changes: DataFrame, folder: str, checkpoint: str) -> None:
    """Drains what is there of aggregate_stream() into a folder, one Parquet folder for each batch; a batch that runs
    again overwrites its own."""

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={number}")

    changes.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(put).trigger(availableNow=True).start().awaitTermination()


def view(changes: DataFrame, by: Sequence[str], batch: str = "batch") -> DataFrame:
    """The view as its last batch left it: the latest row of each group, but for groups that have gone."""
    return latest_by(changes, by, _quoted(batch)).filter("n <> 0").select(*map(_quoted, by), "n", "total", "lo", "hi")
