"""The pattern automaton against plain Python, over whole keys, buckets and shuffled streams."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tessera.streaming.patterns import Pattern, match, match_stream
from tessera.streaming.windows import read_stream

PATTERNS = [
    Pattern.of("a", "b", "c", never=["x"], gap=40),
    Pattern.of("a", ["a", "b"], "a"),
    Pattern.of("a", "a", never=["a", "x"], gap=15),
    Pattern.of("c", never=["x"]),
    Pattern.of(["a", "x"], "b", ["b", "c"], "c", never=["x"], gap=100),
]


def plainly(rows, p):
    """Straight from the definition, run by run."""
    out = []
    for key in {r[0] for r in rows}:
        mine = sorted((t, i, kind) for k, t, i, kind in rows if k == key and t is not None and i is not None)
        seen, before = [], None
        for t, i, kind in mine:
            if before is not None and t - before > p.gap * 1_000_000:
                seen = []
            before = t
            if kind in p.steps[len(seen)]:
                seen.append((t, i))
            elif seen and kind in p.never:
                seen = [(t, i)] if kind in p.steps[0] else []
            if len(seen) == len(p.steps):
                out.append((key, *seen[0], t, i))
                seen = []
    return sorted(out, key=repr)


def some_rows(n=600, seed=1):
    rnd = random.Random(seed)
    rows = [(rnd.choice(["u", "u", "u", "v", None]), rnd.randrange(2_000_000_000) * 2 + 9 * 10**15, i, rnd.choice(["a", "b", "c", "x", "other", None])) for i in range(n)]
    return rows + [("u", None, n, "a"), ("u", 10**9, None, "a"), ("w", 5, n + 1, "a"), ("w", 5, n + 2, "b"), ("w", 5, n + 3, "c")]


def frame(spark, rows, kind="timestamp"):
    df = spark.createDataFrame(rows, "k string, t long, i long, kind string")
    return df.selectExpr("k", f"cast(timestamp_micros(t) as {kind}) AS ts", "i", "kind", "1 AS state")


@pytest.mark.parametrize("p", PATTERNS)
def test_batches_against_plain_python(spark, p):
    """Ties, nulls, clashing names; whole keys, hot keys in buckets of several widths, all keys in buckets."""
    rows = some_rows()
    df, want = frame(spark, rows), plainly(rows, p)
    assert want
    for width, hot in ((None, 0), (10**7, 0), (3 * 10**8, 0), (3 * 10**8, 200), (10**8, 10**6)):
        got = match(df, ["k"], "ts", "i", "kind", p, width and F.floor(F.col("t") / width), hot)
        assert got.columns == ["k", "start_t", "start_id", "end_t", "end_id"]
        assert sorted(map(tuple, got.collect()), key=repr) == want
    assert match(df.limit(0), ["k"], "ts", "i", "kind", p, F.col("t"), 0).count() == 0


def test_other_keys_ids_and_times(spark):
    rows, p = some_rows(200, 2), PATTERNS[0]
    named = frame(spark, rows, "timestamp_ntz").selectExpr("k AS `a.b`", "ts", "concat('id', lpad(i, 5, '0')) AS i", "kind")
    want = [(k, s, f"id{a:05}", e, f"id{b:05}") for k, s, a, e, b in plainly(rows, p)]
    for hot in (None, 0):
        got = match(named, ["a.b"], "ts", "i", "kind", p, None if hot is None else F.floor(F.col("t") / 10**8), hot or 0)
        assert sorted(map(tuple, got.collect()), key=repr) == want
    alone = [("one", *r[1:]) for r in rows]
    got = match(named, [], "ts", "i", "kind", p, F.floor(F.col("t") / 10**8), 0)
    assert sorted((s, e) for s, _, e, _ in got.collect()) == sorted((s, e) for _, s, _, e, _ in plainly(alone, p))


def test_patterns_that_are_refused():
    for bad in ((), ("a", []), ("",)):
        with pytest.raises(ValueError):
            Pattern.of(*bad)


@pytest.mark.parametrize("p", [PATTERNS[0], PATTERNS[4]])
def test_a_shuffled_stream_equals_the_batch(spark, tmp_path, p):
    """Rows in any order over several files; a last event of another key moves the watermark past all. The state is
    shown to shrink to the keys that can still match."""
    rnd = random.Random(5)
    rows = [(r[0] and f"{r[0]}{rnd.randrange(12)}", *r[1:]) for r in some_rows(1200, 3) if r[1] is not None and r[2] is not None and r[0] != "w"]
    rnd.shuffle(rows)
    for n in range(3):
        frame(spark, rows[n::3]).coalesce(1).write.mode("append").parquet(str(tmp_path / "events.parquet"))
    end = 9 * 10**15 + 10**11
    for n in range(3):  # files are read by their times
        frame(spark, [("end", end + n * 10**10, 10**6 + n, "other")]).coalesce(1).write.mode("append").parquet(str(tmp_path / "events.parquet"))
    out = match_stream(read_stream(spark, str(tmp_path), "events", 1), ["k"], "ts", "i", "kind", p, "2 hours")
    query = out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination()
    got = sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect()), key=repr)
    assert got == plainly(rows, p) and got
    held = [json.loads(x.json)["stateOperators"][0]["numRowsTotal"] for x in query.recentProgress if x.json]
    assert max(held) > 20 and held[-1] <= 2, held


def test_a_stream_that_starts_again_goes_on(spark, tmp_path):
    """The run of a key and the events that wait are kept in the checkpoint between two starts."""
    rows = [("u", 10**6 * t, t, kind) for t, kind in ((1, "a"), (5, "b"), (9, "c"), (12, "a"), (15, "b"), (19, "c"))]
    p, out = Pattern.of("a", "b", "c", gap=60), []
    for part in (rows[:2], rows[2:4] + rows[5:], rows[4:5], [("end", 10**12, 100, "a")], [("end", 2 * 10**12, 101, "a")]):
        frame(spark, part).coalesce(1).write.mode("append").parquet(str(tmp_path / "events.parquet"))
        found = match_stream(read_stream(spark, str(tmp_path), "events", 10), ["k"], "ts", "i", "kind", p, "10 seconds")
        found.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
        out = sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect()))
    assert out == plainly(rows, p) and len(out) == 2
