"""Histories against brute force: ties, nulls, open ends, hot keys in buckets."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import relational
from tessera.operators.temporal import coalesce, valid_time_join


def some_rows(seed, n, keys="aab"):
    rnd = random.Random(seed)
    rows = [(rnd.choice([*keys, None]), s := rnd.randrange(1000), s + rnd.choice([-1, 0, 1, 1, 2, 5, 9, 60]), i) for i in range(n)]
    return rows + [("b", 900, None, n), ("b", 950, 960, n + 1), ("c", None, 5, n + 2), ("c", None, 3, n + 3), ("c", 4, 7, n + 4), ("c", 8, None, n + 5), ("d", None, None, n + 6)]


def spans(rows):
    """Islands by joining what overlaps or meets until nothing does."""
    found = {}
    for k, a, b, _ in rows:
        a, b, n = -math.inf if a is None else a, math.inf if b is None else b, 1
        if a >= b:
            continue
        mine = found.setdefault(k, [])
        while hit := next((x for x in mine if x[0] <= b and a <= x[1]), None):
            mine.remove(hit)
            a, b, n = min(a, hit[0]), max(b, hit[1]), n + hit[2]
        mine.append((a, b, n))
    none = lambda x: None if math.isinf(x) else x
    return sorted(((k, none(a), none(b), n) for k, v in found.items() for a, b, n in v), key=repr)


@pytest.mark.parametrize("width, hot", [(None, 0), (7, 0), (100, 0), (5000, 0), (50, 120), (50, 10_000)])
def test_coalesce_against_brute_force(spark, width, hot):
    rows = some_rows(1, 300)
    df = spark.createDataFrame(rows, "k string, a int, b int, _z int")
    got = coalesce(df, ["k"], "a", "b", "rows", width and F.floor(F.col("_a") / width), hot)
    assert got.columns == ["k", "a", "b", "rows"]
    assert sorted(map(tuple, got.collect()), key=repr) == spans(rows) and len(spans(rows)) > 20
    assert coalesce(df.limit(0), ["k"], "a", "b", bucket=width and F.floor(F.col("_a") / width), hot=hot).count() == 0


def test_coalesce_without_a_key_and_with_clashing_names(spark):
    rows = [(None, *r[1:]) for r in some_rows(2, 40) if r[0] in ("a", "b")]
    df = spark.createDataFrame(rows, "k string, _a int, _span int, i int")
    got = [(None, *x) for x in map(tuple, coalesce(df, [], "_a", "_span").collect())]
    assert sorted(got, key=repr) == spans(rows)
    with pytest.raises(ValueError):
        coalesce(df, ["k"], "_a", "_span", out="K")


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz"])
def test_times(spark, kind):
    rows = some_rows(3, 120)
    change = lambda c: f"cast(timestamp_seconds({c} * 86400L) as {kind}) AS {c}"
    df = spark.createDataFrame(rows, "k string, a int, b int, i int").selectExpr("k", change("a"), change("b"), "i")
    back = lambda c: (F.unix_seconds(F.col(c).cast("timestamp")) / 86400).cast("int").alias(c)
    got = coalesce(df, ["k"], "a", "b", bucket=F.date_trunc("month", "_a"), hot=0).select("k", back("a"), back("b"), "n")
    assert sorted(map(tuple, got.collect()), key=repr) == spans(rows)


def test_valid_time_join_against_brute_force(spark):
    """Times at which both hold, checked one unit of time after the other."""
    l, r = some_rows(4, 200), some_rows(5, 150)
    frames = [spark.createDataFrame(x, "k string, a int, b int, i int") for x in (l, r)]
    inf, want = math.inf, []
    for k, a, b, i in l:
        for k2, c, d, j in r:
            lo = max(-inf if a is None else a, -inf if c is None else c)
            hi = min(inf if b is None else b, inf if d is None else d)
            whole = all(x is None or y is None or x < y for x, y in ((a, b), (c, d)))
            if k is not None and k == k2 and whole and lo < hi:
                want.append((i, j, None if lo == -inf else lo, None if hi == inf else hi))
    got = valid_time_join(*frames, ["k"], ("a", "b"), ("a", "b"), 4.0)
    assert got.columns == ["l", "r", "valid_from", "valid_to"]
    assert sorted(((x.l.i, x.r.i, x.valid_from, x.valid_to) for x in got.collect()), key=repr) == sorted(want, key=repr) and len(want) > 60
    assert valid_time_join(frames[0].limit(0), frames[1], ["k"], ("a", "b"), ("a", "b"), 4.0).count() == 0


def test_a_task_gets_a_number_of_rows_however_well_they_compress(spark, monkeypatch):
    monkeypatch.setattr(relational, "ROWS", 50)
    df = spark.createDataFrame(some_rows(1, 300), "k string, a int, b int, i int")
    got = coalesce(df, ["k"], "a", "b")
    assert "REPARTITION_BY_NUM" in got._jdf.queryExecution().toString()
    assert sorted(map(tuple, got.collect()), key=repr) == spans(some_rows(1, 300))
