"""Patterns over the events of a key: a compiled automaton, run over batches and over streams.

A pattern is a row of steps, each a set of kinds of event, with kinds that must never come in between. Of a key's
events in order of (time, id), one of the first step's kinds begins a run; an event of the next step's kinds carries
the run on; one of the `never` kinds ends it without a match; all others are passed over. A run also ends where the
key has no event at all for longer than `gap`. The event of the last step makes a match, and the next run may begin
behind it: matches of a key do not overlap. An event that ends a run may begin the next.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tessera.operators.relational import _hot_keys, _marked, _quoted, micros

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: (state, time and id of the run's first event); without a run (0, None, None).
NO_RUN = (0, None, None)
#: What stands for the first event of a run that began before a bucket.
_BEFORE = object()


@dataclass(frozen=True)
class Pattern:
    """steps: kinds of event of each step; never: kinds that end a run; gap: seconds without an event that do."""

    steps: tuple[frozenset[str], ...]
    never: frozenset[str] = frozenset()
    gap: float = float("inf")

    @staticmethod
    def of(*steps: str | Sequence[str], never: Sequence[str] = (), gap: float = float("inf")) -> Pattern:
        if not steps or not all(steps):
            raise ValueError("a pattern has steps, and each step a kind of event")
        return Pattern(tuple(frozenset([s] if isinstance(s, str) else s) for s in steps), frozenset(never), gap)

    @property
    def symbols(self) -> list[str]:
        """The kinds that a transition depends on; the number behind the last stands for all others."""
        return sorted(self.never.union(*self.steps))

    def symbol(self, kind: Column) -> Column:
        """The number of an event's kind; a null kind is one of the others."""
        out = F.lit(len(self.symbols))
        for k, name in enumerate(self.symbols):
            out = F.when(kind == name, k).otherwise(out)
        return out

    def compiled(self) -> Automaton:
        return Automaton(self)


class Automaton:
    """next[state][symbol]: the state after an event, -1 for a match; state k has seen the first k steps. begins: whether
    an event that leads to state 1, or straight to a match, is the first of its run."""

    def __init__(self, pattern: Pattern):
        self.gap = None if pattern.gap == float("inf") else round(pattern.gap * 1_000_000)
        kinds = [*pattern.symbols, None]
        self.next = []
        for state, step in enumerate(pattern.steps):
            row = []
            for kind in kinds:
                if kind in step:
                    row.append((state + 1, state == 0))
                elif state and kind in pattern.never:
                    row.append((1, True) if kind in pattern.steps[0] else (0, False))
                else:
                    row.append((state, False))
            self.next.append([(-1 if to == len(pattern.steps) else to, begins) for to, begins in row])

    def step(self, run: tuple, t: int, ident, symbol: int) -> tuple[tuple, tuple | None]:
        """(the run after an event, the match that it makes or None)."""
        to, begins = self.next[run[0]][symbol]
        first = (t, ident) if begins else run[1:]
        if to < 0:
            return NO_RUN, (*first, t, ident)
        return (NO_RUN if to == 0 else (to, *first)), None

    def broken(self, before: int | None, t: int) -> bool:
        return self.gap is not None and before is not None and t - before > self.gap


def _events(df: DataFrame, by: Sequence[str], ts: str, ident: str, kind: str, pattern: Pattern) -> DataFrame:
    """(keys, t, id, symbol) of the rows with a time and an id."""
    at = micros(_quoted(ts), df.schema[ts].dataType)
    return df.filter(_quoted(ts).isNotNull() & _quoted(ident).isNotNull()).select(*[_quoted(c).alias(f"_k{i}") for i, c in enumerate(by)], at.alias("t"), _quoted(ident).alias("id"), pattern.symbol(_quoted(kind)).alias("symbol"))


def _matches(automaton: Automaton, keys: list[str], parts: list[str]):
    """A function of sorted rows (keys, parts, ...): the matches of each part of a key. A part's first row may be the run
    that enters it, with the time of the last event before."""

    def run(batches):
        now, state, last, out, schema = None, NO_RUN, None, [], None

        def packed(rows):
            names = [*keys, "start_t", "start_id", "end_t", "end_id"]
            kinds = [*(schema.field(k).type for k in keys), pa.int64(), schema.field("id").type, pa.int64(), schema.field("id").type]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        names = None
        for batch in batches:
            if names is None:
                schema, names = batch.schema, batch.schema.names
                at, symbol, ident, state_at, first_t, first_id = (names.index(c) for c in ("t", "symbol", "id", "state", "first_t", "first_id"))
                own = [names.index(p) for p in parts]
            for row in zip(*(batch[c].to_pylist() for c in names)):
                part = tuple(row[i] for i in own)
                if part != now:
                    now, state, last = part, NO_RUN, None
                if row[state_at] is not None:
                    state, last = (row[state_at], row[first_t], row[first_id]) if row[state_at] else NO_RUN, row[at]
                    continue
                t = row[at]
                if automaton.broken(last, t):
                    state = NO_RUN
                state, match = automaton.step(state, t, row[ident], row[symbol])
                last = t
                if match:
                    out.append((*part[: len(keys)], *match))
            if out:
                yield packed(out)
                out = []

    return run


def _maps(automaton: Automaton, keys: list[str]):
    """A function of sorted rows (keys, _b, t, id, symbol): for each bucket its first and last time, and for each state that
    a run can enter it with the state and the first event that it leaves with; came: it is the one that it came with."""
    states = len(automaton.next)

    def run(batches):
        now, runs, first, last, out, schema = None, [], None, None, [], None

        def done():
            came = [r[1] is _BEFORE or r[0] == 0 for r in runs]
            out.append((*now, first[0], last, [r[0] for r in runs], came, [first[0] if c else r[1] for c, r in zip(came, runs)], [first[1] if c else r[2] for c, r in zip(came, runs)]))

        def packed(rows):
            ident = schema.field("id").type
            kinds = [*(schema.field(k).type for k in (*keys, "_b")), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.list_(ident)]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [*keys, "_b", "lo", "hi", "to", "came", "to_t", "to_id"])

        for batch in batches:
            schema = batch.schema
            names = schema.names
            own = [names.index(k) for k in (*keys, "_b")]
            at, symbol, ident = (names.index(c) for c in ("t", "symbol", "id"))
            for row in zip(*(batch[c].to_pylist() for c in names)):
                part, t = tuple(row[i] for i in own), row[at]
                if part != now:
                    if now is not None:
                        done()
                    now, runs, first, last = part, [NO_RUN, *((k, _BEFORE, _BEFORE) for k in range(1, states))], (t, row[ident]), None
                if automaton.broken(last, t):
                    runs = [NO_RUN] * states
                runs = [automaton.step(r, t, row[ident], row[symbol])[0] for r in runs]
                last = t
            if len(out) >= 5000:
                yield packed(out)
                out.clear()
        if now is not None:
            done()
        if out:
            yield packed(out)

    return run


def _entries(automaton: Automaton):
    """A function of the buckets of a key: the run that enters each, and the last time before it."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("lo", kind="stable").reset_index(drop=True)
        state, last, out = NO_RUN, None, []
        for lo, hi, to, came, to_t, to_id in rows[["lo", "hi", "to", "came", "to_t", "to_id"]].itertuples(index=False):
            out.append((last, *state))
            entry = 0 if automaton.broken(last, lo) else state[0]
            leaves = int(to[entry])
            state = NO_RUN if not leaves else (leaves, *state[1:]) if came[entry] else (leaves, int(to_t[entry]), to_id[entry])
            last = int(hi)
        found = pd.DataFrame(out, columns=["t", "state", "first_t", "first_id"], dtype=object)
        return pd.concat([rows.drop(columns=["lo", "hi", "to", "came", "to_t", "to_id"]), found], axis=1)

    return run


def match(
    df: DataFrame, by: Sequence[str], ts: str, ident: str, kind: str, pattern: Pattern, bucket: Column | None = None, hot: int = 1_000_000
) -> DataFrame:
    """(by..., start_t, start_id, end_t, end_id): times as microseconds and ids of the first and last event of each match.

    Rows are dealt and sorted by key; the automaton reads a task's rows in order and holds one run. `bucket`, a rising
    function of the time `t` in microseconds, splits the rows of keys with more than `hot` rows: first each bucket is made a
    map from the state that enters it to the state that leaves it, one row a bucket; these are chained by key; then every
    bucket is read again from the run that enters it. Bounds of buckets and gaps do not show in the result.

    Rows without a time or an id are left out; a null key is a key; events of equal (time, id) are taken in any order.
    """
    rows = _events(df, by, ts, ident, kind, pattern)
    keys = [f"_k{i}" for i in range(len(by))]
    kinds = dict(rows.dtypes)
    automaton = pattern.compiled()
    columns = ", ".join(f"{k} {kinds[k]}" for k in keys)
    many = None if bucket is None else _hot_keys(rows, keys, hot)
    parts = keys
    runs = [F.lit(None).cast(k).alias(n) for n, k in (("state", "int"), ("first_t", "long"), ("first_id", kinds["id"]))]
    if many is not None:
        rows = _marked(rows, many, keys, "_hot").withColumn("_b", F.when(F.col("_hot"), bucket))
        parts = [*keys, "_b"]
        inner = rows.filter("_hot").select(*parts, "t", "id", "symbol").repartition(*parts).sortWithinPartitions(*parts, "t", "id")
        b = f"_b {dict(rows.dtypes)['_b']}"
        schema = ", ".join(x for x in (columns, b, "lo long, hi long, to array<int>, came array<boolean>, to_t array<long>", f"to_id array<{kinds['id']}>") if x)
        maps = inner.mapInArrow(_maps(automaton, keys), schema)
        schema = ", ".join(x for x in (columns, b, "t long, state int, first_t long", f"first_id {kinds['id']}") if x)
        entries = maps.groupBy(*keys).applyInPandas(_entries(automaton), schema)
        entries = entries.filter("t IS NOT NULL").withColumns({"_first": F.lit(0), "id": F.lit(None).cast(kinds["id"]), "symbol": F.lit(None).cast("int")})
        rows = rows.withColumn("_first", F.lit(1)).select(*parts, "_first", "t", "id", "symbol", *runs).unionByName(entries.select(*parts, "_first", "t", "id", "symbol", "state", "first_t", "first_id"))
    else:
        rows = rows.withColumn("_first", F.lit(1)).select(*parts, "_first", "t", "id", "symbol", *runs)
    dealt = (rows.repartition(*parts) if parts else rows.coalesce(1)).sortWithinPartitions(*parts, "_first", "t", "id")
    schema = ", ".join(x for x in (columns, f"start_t long, start_id {kinds['id']}, end_t long, end_id {kinds['id']}") if x)
    found = dealt.mapInArrow(_matches(automaton, keys, parts), schema)
    return found.select(*[F.col(k).alias(c) for k, c in zip(keys, by)], "start_t", "start_id", "end_t", "end_id")


class _Runs(StatefulProcessor):
    """A key's run and the events that wait until the watermark has passed them, so that they are read in order."""

    def __init__(self, automaton: Automaton, ident: str, keys: list[str]):
        self.automaton, self.ident, self.keys = automaton, ident, keys

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.run = handle.getValueState("run", f"state int, first_t long, first_id {self.ident}, last_t long")
        self.waiting = handle.getListState("waiting", f"t long, id {self.ident}, symbol int")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        came = [r for part in rows for r in zip(part["t"].tolist(), part["id"].tolist(), part["symbol"].tolist())]
        if came:
            self.waiting.appendList(came)
            self.handle.registerTimer(_millis(min(r[0] for r in came)))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = sorted(self.waiting.get()) if self.waiting.exists() else []
        ready = [r for r in waiting if r[0] <= passed]
        later = waiting[len(ready) :]
        *state, last = self.run.get() if self.run.exists() else (*NO_RUN, None)
        state, out = tuple(state), []
        for t, ident, symbol in ready:
            if self.automaton.broken(last, t):
                state = NO_RUN
            state, match = self.automaton.step(state, t, ident, symbol)
            last = t
            if match:
                out.append((*key, *match))
        gap = self.automaton.gap
        if state == NO_RUN or (gap is not None and last + gap <= passed):  # whatever comes is past the gap
            self.run.clear()
        else:
            self.run.update((*state, last))
            if gap is not None:
                self.handle.registerTimer(_millis(last + gap))
        if later:
            if ready:
                self.waiting.put(later)
            self.handle.registerTimer(_millis(later[0][0]))
        elif ready:
            self.waiting.clear()
        if out:
            yield pd.DataFrame(out, columns=[*self.keys, "start_t", "start_id", "end_t", "end_id"])

    def close(self) -> None:
        pass


def _millis(t: int) -> int:
    """The first millisecond at or after a time in microseconds."""
    return -(-t // 1000)


def match_stream(df: DataFrame, by: Sequence[str], ts: str, ident: str, kind: str, pattern: Pattern, late: str) -> DataFrame:
    """match() over a stream, whatever the order in which rows no later than `late` arrive.

    A key's events wait in its state until the watermark has passed them and are then read in order of (time, id). A timer
    for the earliest of them, and one for the end of the gap behind a run's last event, wake the key; its state goes when
    no event waits and no run is open or the gap has passed. (State TTL counts processing time alone, which would make
    results depend on when a stream runs; timers in event time do its work here.) Sets the state store that such
    operators need, if it is not set.
    """
    spark = df.sparkSession
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != ROCKS:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    rows = _events(df, by, ts, ident, kind, pattern).withColumn("_ts", F.timestamp_micros("t"))
    keys = [f"_k{i}" for i in range(len(by))]
    kinds = dict(rows.dtypes)
    schema = ", ".join([*(f"{k} {kinds[k]}" for k in keys), f"start_t long, start_id {kinds['id']}, end_t long, end_id {kinds['id']}"])
    runs = _Runs(pattern.compiled(), kinds["id"], keys)
    found = rows.withWatermark("_ts", late).groupBy(*keys).transformWithStateInPandas(runs, schema, "append", "eventTime")
    return found.select(*[F.col(k).alias(c) for k, c in zip(keys, by)], "start_t", "start_id", "end_t", "end_id")
