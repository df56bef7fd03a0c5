"""Operators on small frames: nulls, ties, empty inputs, clashing names; and streams run to their end."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tessera.functions.scalar import cosine, safe_div
from tessera.operators import relational
from tessera.operators.relational import asof_join, latest_by, overlap_join, range_join, salted_join, sessionize, top_k_per_group
from tessera.streaming.windows import first_seen, interval_join, read_stream, run_to_end, session_counts, tumbling_counts


@pytest.mark.parametrize("bucket", [False, True])
def test_asof_ties_nulls_and_misses(spark, bucket):
    bucket = F.floor(F.col("_t") / 2) if bucket else None
    l = spark.createDataFrame([("a", 5, 1), ("a", 1, 2), (None, 9, 3), ("b", None, 4), ("a", 90, 5), ("c", 7, 6)], "k string, t int, id int")
    r = spark.createDataFrame([("a", 3, 10), ("a", 5, 11), ("a", 5, 12), (None, 1, 13), ("b", 1, 14), ("c", None, 15), ("a", None, 16)], "k string, t int, v int")
    got = {x.id: x.v for x in asof_join(l, r, ["k"], "t", "t", ["v"], bucket, hot=0).collect()}
    assert got == {1: 12, 2: None, 3: None, 4: None, 5: 12, 6: None}
    assert asof_join(l, r.limit(0), ["k"], "t", "t", ["v"], bucket, hot=0).filter("v IS NOT NULL").count() == 0
    assert asof_join(l.limit(0), r, ["k"], "t", "t", ["v"], bucket, hot=0).count() == 0
    with pytest.raises(ValueError):
        asof_join(l, r, ["k"], "t", "t", ["t"])


def test_asof_buckets_agree_with_brute_force(spark):
    """Nulls on both sides; every key whole, some split, all split."""
    rnd = random.Random(1)
    l = [(rnd.choice(["a", "b", "c", None]), rnd.choice([None, *[rnd.randrange(300)] * 9]), i) for i in range(150)]
    r = [(rnd.choice(["a", "a", "b", None]), rnd.choice([None, *[rnd.randrange(300)] * 9]), i) for i in range(50)]
    left, right = spark.createDataFrame(l, "k string, _l int, _r int"), spark.createDataFrame(r, "k string, t int, v int")
    want = {}
    for k, at, i in l:
        best = max(((t, v) for k2, t, v in r if None not in (k, at, t) and k2 == k and t <= at), default=(0, None))
        want[i] = best[1]
    assert len({v for v in want.values()}) > 10
    for width, hot in ((1, 0), (30, 0), (1000, 0), (30, 60), (30, 10_000), (None, 0)):
        got = asof_join(left, right, ["k"], "_l", "t", ["v"], width and F.floor(F.col("_t") / width), hot)
        assert got.columns == ["k", "_l", "_r", "v"] and {x["_r"]: x["v"] for x in got.collect()} == want


def test_latest_keeps_rows_without_an_order(spark):
    df = spark.createDataFrame([("a", None, 7), ("b", 1, 2), ("b", 3, None), ("b", None, 9), (None, 1, 1)], "k string, t int, _best int")
    got = {x.k: (x.t, x["_best"]) for x in latest_by(df, ["k"], F.col("t")).collect()}
    assert got == {"a": (None, 7), "b": (3, None), None: (1, 1)}
    assert latest_by(df.limit(0), ["k"], F.col("t")).count() == 0


def test_top_k(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 5), (None, 2), (None, 3)], "k string, v int")
    got = sorted((str(x.k), x.v, x.place) for x in top_k_per_group(df, ["k"], [F.desc("v")], 2, "place").collect())
    assert got == [("None", 2, 2), ("None", 3, 1), ("a", 1, 2), ("a", 5, 1)]
    with pytest.raises(ValueError):
        top_k_per_group(df, ["k"], [F.desc("v")], 2, "V")


@pytest.mark.parametrize("width", [0.5, 8.0, 1e6])
def test_range_join_against_brute_force(spark, width):
    rnd, inf = random.Random(2), math.inf
    points = [(rnd.choice("ab"), rnd.choice([-3.0, 0.0, 1e11, -1e9]) + rnd.randrange(40), i) for i in range(120)] + [("a", None, 200), (None, 1.0, 201)]
    spans = [(rnd.choice("ab"), s := float(rnd.randrange(-5, 40)), s + rnd.choice([0, 1, 2, 7, 100, 1e12]), i) for i in range(40)]
    spans += [("a", -inf, 5.0, 50), ("b", 3.0, inf, 51), ("a", None, 5.0, 52), ("a", 5.0, 1.0, 53), (None, 0.0, 9.0, 54), ("a", math.nan, 4.0, 55), ("a", 0.0, math.nan, 56), ("b", -1e12, 1e12, 57)]
    l, r = spark.createDataFrame(points, "k string, p double, _level int"), spark.createDataFrame(spans, "k string, lo double, hi double, _at int")
    got = range_join(l, r, ["k"], "p", "lo", "hi", width)
    assert got.columns == ["k", "p", "_level", "lo", "hi", "_at"]
    want = sorted((i, j) for k, p, i in points for k2, lo, hi, j in spans if k is not None and k == k2 and None not in (p, lo) and lo <= p < hi)
    assert sorted((x["_level"], x["_at"]) for x in got.collect()) == want and len(want) > 300
    assert range_join(l, r.limit(0), ["k"], "p", "lo", "hi", width).count() == 0


TIMES = ["timestamp", "timestamp_ntz"]


@pytest.mark.parametrize("kind", TIMES)
def test_range_join_on_times_and_shared_names(spark, kind):
    rnd = random.Random(5)
    points = [(rnd.choice("ab"), rnd.randrange(100_000), i) for i in range(80)] + [("a", None, 90)]
    spans = [(rnd.choice("ab"), s := rnd.randrange(100_000), s + rnd.choice([0, 1, 50, 3000, 90_000]), i) for i in range(40)] + [("a", 3, None, 50)]
    l = spark.createDataFrame(points, "k string, s long, id int").selectExpr("k", f"cast(timestamp_seconds(s / 7) as {kind}) AS t", "id AS x")
    r = spark.createDataFrame(spans, "k string, a long, b long, id int").selectExpr("k", f"cast(timestamp_seconds(a / 7) as {kind}) AS t", f"cast(timestamp_seconds(b / 7) as {kind}) AS hi", "id AS y")
    want = sorted((i, j) for k, p, i in points for k2, a, b, j in spans if k == k2 and None not in (p, b) and a <= p < b)
    got = range_join(l, r, ["k"], "t", "t", "hi", 100.0)
    assert got.columns == ["k", "t", "x", "t", "hi", "y"]
    assert sorted((v[2], v[5]) for v in got.collect()) == want and len(want) > 100


def overlapping(l, r, open_ended):
    """Pairs of numbers by the definition: both spans hold the later start."""
    inf, out = math.inf, []
    for k, a, b, i in l:
        for k2, c, d, j in r:
            if k is None or k != k2 or (not open_ended and None in (a, b, c, d)):
                continue
            lo1, hi1, lo2, hi2 = (-inf if a is None else a), (inf if b is None else b), (-inf if c is None else c), (inf if d is None else d)
            if lo1 < hi1 and lo2 < hi2 and lo1 < hi2 and lo2 < hi1:
                out.append((i, j))
    return sorted(out)


def some_spans(seed, n):
    rnd, inf = random.Random(seed), math.inf
    spans = [(rnd.choice("ab"), s := float(rnd.randrange(-50, 200)), s + rnd.choice([-1, 0, 1, 1, 2, 7, 100, 1e9]), i) for i in range(n)]
    spans += [(k, *x, n + i) for k in ("a", None) for i, x in enumerate([(None, 5.0), (5.0, None), (None, None), (-inf, 9.0), (40.0, inf), (-inf, inf), (math.nan, 4.0), (4.0, math.nan), (math.nan, None), (3.0, 3.0)])]
    return spans


@pytest.mark.parametrize("unit, open_ended", [(0.5, False), (8.0, True), (1e6, False), (3.0, True)])
def test_overlap_join_against_brute_force(spark, unit, open_ended):
    """Ties, nulls, empty and endless spans, shared names; each pair once."""
    l, r = some_spans(1, 90), some_spans(2, 80)
    frames = [spark.createDataFrame(x, "k string, lo double, hi double, _level int") for x in (l, r)]
    got = overlap_join(*frames, ["k"], ("lo", "hi"), ("lo", "hi"), unit, open_ended)
    want = overlapping(l, r, open_ended)
    assert sorted((x.l["_level"], x.r["_level"]) for x in got.collect()) == want and len(want) > 500
    assert overlap_join(frames[0].limit(0), frames[1], ["k"], ("lo", "hi"), ("lo", "hi"), unit).count() == 0
    assert overlap_join(frames[0], frames[1].limit(0), ["k"], ("lo", "hi"), ("lo", "hi"), unit).count() == 0


@pytest.mark.parametrize("kind", [*TIMES, "date"])
def test_overlap_join_on_times_without_a_key(spark, kind):
    l, r = ([("", a, b, i) for k, a, b, i in some_spans(seed, 50)[:60] if not any(math.isinf(x or 0) or math.isnan(x or 0) or (x or 0) > 1e6 for x in (a, b))] for seed in (3, 4))
    frames = [spark.createDataFrame(x, "k string, a double, b double, id int").selectExpr(*[f"cast(timestamp_seconds({c} * 86400) as {kind}) AS {c}" for c in "ab"], "id") for x in (l, r)]
    got = overlap_join(*frames, [], ("a", "b"), ("a", "b"), 86_400.0, open_ended=True)
    assert sorted((x.l.id, x.r.id) for x in got.collect()) == overlapping(l, r, True)


def test_overlap_join_plan_has_no_nested_loop(spark):
    """Both halves are equi-joins, also where spans have no key."""
    df = spark.range(1000).selectExpr("id AS a", "id + 5 AS b")
    text = overlap_join(df, df, [], ("a", "b"), ("a", "b"), 4.0)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_overlap_join_is_one_join_at_every_size(spark):
    """Rows meet in one shuffled join, whatever the estimates are; each is copied to few cells."""
    l = spark.range(3000).selectExpr("id", "id % 7 AS k", "id * 3 AS a", "id * 3 + 20 AS b")
    r = spark.range(3000).selectExpr("id", "id % 7 AS k", "id * 3 + 1 AS a", "id * 3 + 2 + id % 50 AS b")
    got = overlap_join(l, r, ["k"], ("a", "b"), ("a", "b"), 8.0)
    pairs = got.collect()
    want = l.alias("l").join(r.alias("r"), "k").where("l.a < r.b AND r.a < l.b").count()
    assert len({(x.l.id, x.r.id) for x in pairs}) == len(pairs) == want > 1000
    text = got._jdf.queryExecution().sparkPlan().toString()
    assert text.count("SortMergeJoin") == 1 and "BroadcastHashJoin" not in text
    one, other = (x.selectExpr("cast(a AS double) AS lo", "cast(b AS double) AS hi").withColumn("_own", relational._level(8.0)) for x in (l, r))
    assert relational._placed(one, other, 8.0, (-1, -2)).count() <= 3000 * 5
    assert relational._placed(other, one, 8.0, (-2, -1)).count() <= 3000 * 2.5


@pytest.mark.parametrize("right_rows", [2, 300])
def test_salted_join(spark, right_rows):
    l = spark.createDataFrame([("hot", i) for i in range(200)] + [("cold", 1), (None, 2), ("alone", 3)], "k string, _salt int")
    r = spark.createDataFrame([("hot", "x"), ("hot", "y"), ("cold", "z"), (None, "n")] + [(f"k{i}", "w") for i in range(right_rows)], "k string, _hot string")
    want = sorted(map(str, l.join(r, "k").collect()))
    for hot, small in ((0, 0), (10, 0), (10, 100), (1000, 0)):
        got = salted_join(l, r, ["k"], hot, 4, small)
        assert got.columns == ["k", "_salt", "_hot"] and sorted(map(str, got.collect())) == want
    assert salted_join(l.limit(0), r, ["k"], small=0).count() == 0


def test_salted_join_parts_equal_rows_in_a_shuffle(spark):
    """Rows narrowed to their key are all alike: the forced shuffle join still spreads them."""
    l = spark.range(0, 60_000, 1, 16).selectExpr("'hot' AS k")
    r = spark.createDataFrame([("hot", 1), ("cold", 2)], "k string, v int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = salted_join(l, r, ["k"], hot=1000, salts=8, small=0)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        parts = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "SortMergeJoin" in plan and sum(p[1] for p in parts) == 60_000
    assert len(parts) > 2 and max(p[1] for p in parts) < 45_000


@pytest.mark.parametrize("bucket, hot", [(None, 0), ("hour", 0), ("hour", 90), ("hour", 10_000)])
@pytest.mark.parametrize("kind", TIMES)
def test_sessions_with_and_without_buckets(spark, bucket, hot, kind):
    """Whole keys, split ones, both; to the microsecond."""
    rnd = random.Random(3)
    rows = [(rnd.choice(["a", "a", "b", None]), rnd.randrange(40_000_000_000), i) for i in range(300)] + [("a", None, 900)]
    rows += [("c", 100_000, 901), ("c", 9_900_000, 902), ("c", 609_900_000, 903), ("c", 1_209_900_001, 904)]
    df = spark.createDataFrame(rows, "k string, s long, _new int").selectExpr("k", f"cast(timestamp_micros(s) as {kind}) AS ts", "_new")
    want, last = {}, {}
    for k, s, i in sorted(rows, key=lambda x: (str(x[0]), x[1] is not None, x[1] or 0)):
        n, before = last.get(k, (0, None))
        n += before is not None and s is not None and s - before > 600_000_000
        last[k] = (n, s)
        want[i] = n
    out = sessionize(df, ["k"], "ts", 600, "visit", bucket and F.date_trunc(bucket, "ts"), hot)
    assert out.columns == ["k", "ts", "_new", "visit"] and {x["_new"]: x["visit"] for x in out.collect()} == want
    assert [want[i] for i in (901, 902, 903, 904)] == [0, 0, 0, 1]
    assert sessionize(df.limit(0), ["k"], "ts", 10, bucket=bucket and F.date_trunc(bucket, "ts"), hot=hot).count() == 0
    with pytest.raises(ValueError):
        sessionize(df, ["k"], "ts", 10, "_new")


def test_sessions_part_at_fractions_of_a_second(spark):
    df = spark.sql("SELECT 1 AS k, timestamp_micros(v) AS ts FROM VALUES (100000L), (9900000L) AS t(v)")
    assert {x.session for x in sessionize(df, ["k"], "ts", 9).collect()} == {0, 1}
    assert {x.session for x in sessionize(df, ["k"], "ts", 9.8).collect()} == {0}


def test_windows_on_a_key_called_w(spark):
    df = spark.sql("SELECT timestamp_seconds(v) AS ts, v % 2 AS w, 1.0 AS value FROM VALUES (1), (2), (3), (100) AS t(v)")
    assert {(x.w, x.n) for x in tumbling_counts(df, "ts", "1 minute", "1 hour", "w").collect()} == {(1, 2), (0, 1)} | {(0, 1)}
    assert sorted((x.w, x.n) for x in session_counts(df, "ts", "30 seconds", "1 hour", "w").collect()) == [(0, 1), (0, 1), (1, 2)]


def test_first_seen_of_a_batch_is_the_first(spark):
    df = spark.sql("SELECT timestamp_seconds(v) AS ts, k, v AS row FROM VALUES (5, 'a'), (1, 'a'), (null, 'b'), (9, 'b'), (null, 'c'), (3, null) AS t(v, k)")
    got = first_seen(df, "ts", "1 hour", "k")
    assert got.columns == ["ts", "k", "row"] and {x.k: x.row for x in got.collect()} == {"a": 1, "b": 9, "c": None, None: 3}


def test_scalar_functions(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0]), ([0.0], [1.0]), (None, [1.0]), ([1.0, None], [1.0])], "a array<double>, b array<double>")
    assert [x.c for x in df.select(cosine(F.col("a"), F.col("b")).alias("c")).collect()] == [0.96, None, None, 1.0]
    pairs = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (None, 1.0), (1.0, None)], "a double, b double")
    assert [x.c for x in pairs.select(safe_div(F.col("a"), F.col("b")).alias("c")).collect()] == [0.5, None, None, None]


SF = "/root/testdata/sf0.001"


@pytest.fixture
def streamed(spark, tmp_path):
    """The events of sf0.001 in time order as files of a stream; what a function of the stream wrote at its end."""
    spark.read.parquet(f"{SF}/events.parquet").repartitionByRange(3, "ts").write.parquet(str(tmp_path / "events.parquet"))

    def run(f):
        out = f(read_stream(spark, str(tmp_path), "events", 1))
        run_to_end(out, str(tmp_path / "out"), str(tmp_path / "cp"))
        return spark.read.parquet(str(tmp_path / "out")).collect()

    return run


def test_tumbling_stream_equals_batch(spark, streamed):
    batch = tumbling_counts(spark.read.parquet(f"{SF}/events.parquet"), "ts", "1 day", "1 hour", "event_type")
    want = {(r.start, r.event_type): r.n for r in batch.collect()}
    got = {(r.start, r.event_type): r.n for r in streamed(lambda s: tumbling_counts(s, "ts", "1 day", "30 days", "event_type"))}
    assert all(want[k] == n for k, n in got.items())
    got |= {(r.start, r.event_type): r.n for r in batch.collect() if (r.start, r.event_type) not in got}
    assert got == want


def test_session_stream_equals_batch(spark, streamed):
    """Sessions that the watermark has closed come out as in the batch; a session is never given out twice."""
    want = {(r.user_id, r.start): (r.until, r.n) for r in session_counts(spark.read.parquet(f"{SF}/events.parquet"), "ts", "6 hours", "1 hour", "user_id").collect()}
    rows = streamed(lambda s: session_counts(s, "ts", "6 hours", "20 days", "user_id"))
    got = {(r.user_id, r.start): (r.until, r.n) for r in rows}
    assert len(got) == len(rows) > 0 and got.items() <= want.items()


def test_first_seen_stream(spark, streamed):
    rows = streamed(lambda s: first_seen(s, "ts", "60 days", "user_id", "event_type").select("user_id", "event_type"))
    want = spark.read.parquet(f"{SF}/events.parquet").select("user_id", "event_type").distinct().count()
    assert len(rows) == len(set(rows)) == want


def test_interval_join_stream(spark, streamed):
    def pairs(events):
        side = lambda kind: events.filter(F.col("event_type") == kind).select("event_id", "user_id", "ts")
        return interval_join(side("click"), side("view"), "ts", "60 days", "12 hours", "user_id").select(F.col("a.event_id").alias("x"), F.col("b.event_id").alias("y"))

    want = sorted(map(tuple, pairs(spark.read.parquet(f"{SF}/events.parquet")).collect()))
    assert sorted(map(tuple, streamed(pairs))) == want and want
