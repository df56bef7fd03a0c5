"""Views from inserts and deletes against recomputation, in batches and in streams."""

import random
from collections import Counter
from decimal import Decimal

import pytest

from tessera.operators import relational
from tessera.streaming import views
from tessera.streaming.windows import read_stream

LEFT, RIGHT = "k int, v decimal(9,2), `a.t` timestamp, w long", "k int, g string, b long, w long"


def some_batches(seed, n=4):
    """Batches of inserts and deletes of both sides: repeated rows, nulls, a hot key, deletes of extremes, of all, and
    before the insert."""
    rnd = random.Random(seed)
    left, right, out = [], [], []
    when = [None, "2024-01-01 00:00:00.123456", "1969-12-31 23:59:59.999999"]
    for k in range(n):
        dl = [((rnd.choice([1, 1, 1, 2, 3, None]), rnd.choice([None, Decimal("1.50"), Decimal("-3.25"), Decimal(rnd.randrange(9))]), rnd.choice(when)), 1) for _ in range(12)]
        dr = [((rnd.choice([1, 2, 2, 3, None]), rnd.choice(["x", "y", None]), rnd.choice([2**62 + 1, 5])), 1) for _ in range(4)]
        for held, fresh, share in ((left, dl, 0.5), (right, dr, 0.3)):
            gone = [r for r in held if k == n - 1 or rnd.random() < share]
            for r in gone:
                held.remove(r)
            held += [r for r, _ in fresh]
            fresh += [(r, -1) for r in gone]
            rnd.shuffle(fresh)
        if k == 1:
            early = (1, Decimal("99.99"), None)
            dl.append((early, -1))
        if k == 2:
            dl.append(((1, Decimal("99.99"), None), 1))
        out.append((dl, dr))
    return out


def recomputed(batches):
    """(k, g) -> (n, total, lo, hi) of the join of all that is there."""
    l, r = Counter(), Counter()
    for dl, dr in batches:
        for held, d in ((l, dl), (r, dr)):
            for row, w in d:
                held[row] += w
    found = {}
    for (k, v, at), m in l.items():
        for (k2, g, b), m2 in r.items():
            if k is not None and k == k2 and m * m2:
                n, total, values = found.setdefault(g, (0, Decimal(0), Counter()))
                values[v] += m * m2
                found[g] = (n + m * m2, total + (v or 0) * m * m2, values)
    there = {g: (n, total, [v for v, w in values.items() if w > 0 and v is not None]) for g, (n, total, values) in found.items() if n}
    known = {g: any(v is not None and w for v, w in found[g][2].items()) for g in there}
    return {g: (n, total if known[g] or vs else None, min(vs, default=None), max(vs, default=None)) for g, (n, total, vs) in there.items()}


def frames(spark, dl, dr):
    l = spark.createDataFrame([(*r, w) for r, w in dl], "k int, v decimal(9,2), t string, w long").selectExpr("k", "v", "cast(t AS timestamp) AS `a.t`", "w")
    return l, spark.createDataFrame([(*r, w) for r, w in dr], RIGHT)


def as_dict(df):
    rows = df.collect()
    out = {r.g: (r.n, r.total, r.lo, r.hi) for r in rows}
    assert len(out) == len(rows)
    return out


def test_batches_against_recomputation(spark):
    batches = some_batches(1)
    left, right = (df.limit(0) for df in frames(spark, [((1, None, None), 1)], [((1, None, 1), 1)]))
    now = None
    for k, (dl, dr) in enumerate(batches):
        a, b = frames(spark, dl, dr)
        before = views.join_changes(left.limit(0), left, right.limit(0), right, ["k"])
        changes = views.join_changes(left, a, right, b, ["k"])
        touched = views.aggregate_changes(before, changes, ["g"], "v")
        now = touched.filter("n <> 0") if now is None else views.updated(now, touched, ["g"])
        now = spark.createDataFrame(now.collect(), now.schema)
        assert as_dict(now) == recomputed(batches[: k + 1])
        left, right = (views.consolidate(x.unionByName(y)) for x, y in ((left, a), (right, b)))
        left, right = (spark.createDataFrame(x.collect(), x.schema) for x in (left, right))
    assert views.aggregate_changes(left.limit(0), left.limit(0), ["k"], "v").count() == 0


@pytest.mark.parametrize("parts", [1, 3])
def test_streams_against_recomputation_after_each_batch(spark, tmp_path, parts):
    """Two queries, a join and an aggregate behind it, that stop and start again between batches."""
    at = {n: str(tmp_path / n) for n in ("l.parquet", "r.parquet", "joined.parquet", "view", "c1", "c2")}
    batches = some_batches(2, 3)
    for k, (dl, dr) in enumerate(batches):
        for df, name in zip(frames(spark, dl, dr), ("l.parquet", "r.parquet")):
            df.coalesce(1).write.mode("append").parquet(at[name])
        joined = views.join_stream(read_stream(spark, str(tmp_path), "l", 9), read_stream(spark, str(tmp_path), "r", 9), ["k"], parts)
        assert joined.columns == ["k", "v", "a.t", "g", "b", "w"]
        joined.writeStream.format("parquet").option("path", at["joined.parquet"]).option("checkpointLocation", at["c1"]).trigger(availableNow=True).start().awaitTermination()
        views.keep_view(views.aggregate_stream(read_stream(spark, str(tmp_path), "joined", 9), ["g"], "v"), at["view"], at["c2"])
        got = views.view(spark.read.parquet(at["view"]), ["g"])
        assert as_dict(got) == recomputed(batches[: k + 1]), k
    kept = views.consolidate(spark.read.parquet(at["joined.parquet"])).collect()
    l, r = Counter(), Counter()
    for dl, dr in batches:
        for row, w in dl:
            l[row] += w
        for row, w in dr:
            r[row] += w
    want = Counter({(k, v, t, g, b): m * m2 for (k, v, t), m in l.items() for (k2, g, b), m2 in r.items() if k is not None and k == k2 and m * m2})
    assert Counter({(x.k, x.v, x["a.t"] and x["a.t"].strftime("%Y-%m-%d %H:%M:%S.%f"), x.g, x.b): x.w for x in kept}) == want


def test_values_that_would_drift_are_refused(spark):
    df = spark.createDataFrame([("a", 0.1, 1)], "g string, v double, w long")
    for f in (views.aggregate, lambda *a: views.aggregate_changes(a[0], *a)):
        with pytest.raises(ValueError):
            f(df, ["g"], "v")


def test_a_task_of_a_batch_join_gets_a_number_of_rows(spark, monkeypatch):
    monkeypatch.setattr(relational, "ROWS", 10)
    l = spark.createDataFrame([(i % 7, i, 1) for i in range(30)], "k int, a int, w long")
    r = spark.createDataFrame([(i % 5, -i, 1) for i in range(20)], "k int, b int, w long")
    got = views.join_changes(l, l.limit(4), r, r.limit(3), ["k"])
    assert "REPARTITION_BY_NUM" in got._jdf.queryExecution().toString()
    ls, rs = [tuple(x) for x in l.collect()], [tuple(x) for x in r.collect()]
    dl, dr = ls[:4], rs[:3]
    want = [(x[0], x[1], y[1], 1) for a, b in ((dl, rs + dr), (ls, dr)) for x in a for y in b if x[0] == y[0]]
    assert sorted(map(tuple, got.collect())) == sorted(want) and want
