"""Near-duplicate join, substring dedup and mixing against brute force on small, odd tables."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from tessera.llm import components, mixing, parity, substring

SCHEMA = "doc_id long, text string, source string, root long, c string"


def family(seed=1, n=60):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    rows = []
    for k in range(n):
        base = [rnd.choice(vocab) for _ in range(rnd.choice([0, 1, 2, 3, 4, 5, 9, 30, 60, 200]))]
        for _ in range(rnd.choice([1, 1, 2, 5])):
            w = list(base)
            for _ in range(rnd.choice([0, 0, 1, 2, 6])):
                if w:
                    w[rnd.randrange(len(w))] = rnd.choice(vocab)
            sep = rnd.choice([" ", " ", "\n", "\t "])
            text = sep.join(w)
            rows.append(text.upper() if rnd.random() < 0.2 else text)
    rows += [None, "", "  \n", "x", "X", "x", "Ä b c d e", "ä b c d e"]
    rnd.shuffle(rows)
    return rows


def sets(text, n):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return {tuple(w)} if 0 < len(w) < n else {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()


def brute_components(texts, n, percent):
    s, root = [sets(t, n) for t in texts], list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(s)):
        for j in range(i):
            k = len(s[i] & s[j])
            if k and 100 * k >= percent * (len(s[i]) + len(s[j]) - k):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(s))], [len(x) for x in s]


@pytest.mark.parametrize(("n", "percent"), [(4, 85), (5, 80), (1, 80)])
def test_parity_join(spark, n, percent):
    texts = family(n)
    df = spark.createDataFrame([(i, t, "s", 5, "c") for i, t in enumerate(texts)], SCHEMA)
    roots, sizes = brute_components(texts, n, percent)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in parity.join(df, n=n, percent=percent).collect()}
    assert got == {i: (sizes[i], roots[i]) for i in range(len(texts))}
    kept = sorted(r.doc_id for r in parity.keep_one(df, n=n, percent=percent).collect())
    assert kept == sorted(set(roots))


def test_parity_degenerate(spark):
    df = spark.createDataFrame([(None, "a b c d e f", "s", 1, "c"), (7, "a b c d e f", "s", 1, "c"), (7, "a b c d e f", "s", 1, "c"), (3, None, "s", 1, "c"), (3, "q", "s", 1, "c")], SCHEMA)
    got = sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in parity.join(df).collect())
    assert got == [("3", 0, 3), ("3", 1, 3), ("7", 3, 7), ("7", 3, 7), ("None", 3, 7)]
    assert sorted((r.doc_id, r.text) for r in parity.keep_one(df).collect() if r.text) == [(3, "q"), (7, "a b c d e f")]
    assert parity.join(df.limit(0)).count() == 0 and parity.keep_one(df.limit(0)).columns == df.columns


def copies(n_words, m, seed, cut=False):
    """A family of near copies of one text, most of them around a similarity of 0.85 with it and unlike each other."""
    rnd = random.Random(seed)
    base = [f"w{rnd.randrange(10**6)}" for _ in range(n_words)]
    out = []
    for _ in range(m):
        w = list(base)
        for _ in range(rnd.randint(0, n_words // 25)):
            w[rnd.randrange(len(w))] = f"x{rnd.randrange(10**6)}"
        if cut and rnd.random() < 0.5:
            k = rnd.randint(0, n_words // 5)
            w = w[k:] if rnd.random() < 0.5 else w[: len(w) - k]
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize(("cut", "pivots"), [(False, 8), (True, 8), (True, 1)])
def test_parity_family_around_the_limit(spark, monkeypatch, cut, pivots):
    """Members that do not link are told apart, whatever the rounds, and near copies stay few pairs."""
    monkeypatch.setattr(parity, "PIVOTS", pivots)
    monkeypatch.setattr(parity, "BLOCK", 2000)
    texts = copies(120, 260, 3, cut) + copies(40, 60, 4, cut)
    tested, plain = [], parity._verified

    def counted(pairs, *rest):
        tested.append(pairs.count())
        return plain(pairs, *rest)

    monkeypatch.setattr(parity, "_verified", counted)
    df = spark.createDataFrame([(i, t, "s", 5, "c") for i, t in enumerate(texts)], SCHEMA).repartition(3)
    roots, sizes = brute_components(texts, 4, 85)
    assert 20 < len(set(roots)) < 200
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in parity.join(df).collect()}
    assert got == {i: (sizes[i], roots[i]) for i in range(len(texts))}
    if not cut:
        assert sum(tested) < 6 * len(texts)


def test_parity_clashing_names(spark):
    rows = [(i, "a b c d e f", i, "x", 1, "r", 2, 3) for i in range(3)] + [(9, "q w e r t y", 1, "x", 1, "r", 2, 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _gone long, _i string, c int, row string, root int, n int")
    for frame in (df, df.unionAll(df)):  # ids that name a row each, and repeated ones
        got = parity.keep_one(frame)
        assert got.columns == df.columns and sorted(r.doc_id for r in got.collect()) == [0, 9]


def test_parity_long_text(spark):
    rnd = random.Random(6)
    w = [f"w{rnd.randrange(10**6)}" for _ in range(200_000)]
    df = spark.createDataFrame([(5, " ".join(w)), (3, " ".join(w[:195_000])), (1, " ".join(w[:100_000]))], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in parity.join(df).collect()} == {5: 3, 3: 3, 1: 1}


def test_parts_always_meet():
    """Sets at the limit of the similarity share a key, in every size band."""
    rnd = np.random.default_rng(2)
    for n in [6, 7, 8, 11, 13, 20, 40, 77, 150, 400, 1500]:
        for _ in range(60):
            u = rnd.integers(0, 1 << 63, n, np.uint64)
            drop = n - -(-85 * n // 100)
            a_only = rnd.integers(0, drop + 1)
            a, b = np.unique(np.delete(u, range(a_only))), np.unique(np.delete(u, range(n - drop + a_only, n)))
            if len(np.intersect1d(a, b)) * 100 >= 85 * n and not np.array_equal(a, b):
                (x, p), (y, q) = parity.keys(a, 85), parity.keys(b, 85)
                assert len(np.intersect1d(x, y)) >= max(p, q, 1), (n, a_only)


def test_components(spark):
    rnd = random.Random(4)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(150)] + [(i, i + 1) for i in range(1000, 1040)] + [(2000, 2000 + i) for i in range(1, 50)]
    near = defaultdict(set)
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    want = {}
    for x in sorted(near):
        if x not in want:
            stack = [x]
            while stack:
                y = stack.pop()
                if y not in want:
                    want[y] = x
                    stack += near[y]
    want = {k: v for k, v in want.items() if near[k] != {k}}
    for one_task in (0, 10_000):
        got = {r.node: r.label for r in components.components(spark.createDataFrame(edges, "a long, b long"), one_task).collect()}
        assert got == want


def brute_substring(rows, width):
    seen, gone = set(), defaultdict(set)
    for i, words in rows:
        for s in range(len(words) - width + 1):
            g = tuple(words[s : s + width])
            if g in seen:
                gone[i].update(range(s, s + width))
            seen.add(g)
    return gone


@pytest.mark.parametrize("base", [2, 3, 10])
def test_substring(spark, base):
    rnd = random.Random(base)
    vocab = ["a", "b", "c d", "é\n", "f"] if base < 5 else [f"v{i}" for i in range(50)]
    passages = [" ".join(rnd.choice(vocab) for _ in range(rnd.randint(1, 45))) for _ in range(20)]
    texts = [" ".join(rnd.choice(passages) if rnd.random() < 0.6 else rnd.choice(vocab) for _ in range(rnd.randint(0, 12))) for _ in range(60)]
    texts += [None, "", " ", " lead " + passages[0], "z " * 500]
    rnd.shuffle(texts)
    df = spark.createDataFrame([(i, t, "s", 1, "c") for i, t in enumerate(texts)], SCHEMA)
    words = [(i, (t or "").encode().split()) for i, t in enumerate(texts)]
    gone = brute_substring(words, 2 * base)
    got = {r.row.doc_id: r for r in substring.dedup(df, base=base).collect()}
    assert len(got) == len(texts)
    for i, w in words:
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone[i])
        r = got[i]
        assert (r.n_words, r.n_removed, r.kept_sha256) == (len(w), len(gone[i]), hashlib.sha256(kept).hexdigest())
        assert b" ".join((r.kept_text or "").encode().split()) == kept
        assert r.n_removed or r.kept_text == texts[i]


@pytest.mark.parametrize("base", [2, 10])
def test_repeated_spans_double_until_none_repeat(spark, base):
    rnd = random.Random(base)
    words = lambda n: [f"v{rnd.randrange(10**6)}" for _ in range(n)]
    long, short = words(170), words(25)
    texts = [words(3) + long, words(8) + long[:90] + words(2), long[50:], short + words(5) + short, words(60), [], ["z"] * 50]
    df = spark.createDataFrame([(i, " ".join(t) or None, "s", 1, "c") for i, t in enumerate(texts)], SCHEMA)
    want, width = {}, 2 * base
    while True:
        at = defaultdict(list)
        for i, t in enumerate(texts):
            for k in range(len(t) - width + 1):
                at[tuple(t[k : k + width])].append((i, k))
        repeats = {p for places in at.values() if len(places) > 1 for p in places}
        if not repeats:
            break
        want |= dict.fromkeys(repeats, width)
        width *= 2
    assert width >= 128
    got = substring.repeated_spans(df, base=base).collect()
    assert len(got) == len(want) and {(r._id, r["at"]): r.width for r in got} == want
    assert substring.repeated_spans(df.filter("doc_id = 4"), base=base).count() == 0


def test_substring_long_texts_and_clashing_names(spark):
    rnd = random.Random(12)
    words = [f"v{rnd.randrange(10**6)}" for _ in range(120_000)]
    texts = [" ".join(words), " ".join(words[50_000:] + ["end"]), " ".join(words[:19]), None]
    rows = [(3 * i, t, i, i, i, i, i, i, i) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row int, _id int, _m int, hits int, starts int, k int, n_words int").repartition(2)
    got = {r.row.doc_id: r for r in substring.dedup(df).collect()}
    assert [(got[3 * i].n_words, got[3 * i].n_removed) for i in range(4)] == [(120_000, 0), (70_001, 70_000), (19, 0), (0, 0)]
    assert got[3].kept_text == "end" and all(tuple(got[3 * i].row)[2:] == (i,) * 7 for i in range(4))


def test_substring_block_and_least_place():
    """Of a block's windows the least place of each goes on, once; later places are known, equal ones dropped."""
    h, w = np.array([7, 7, 7, 7, 8, 7]), np.array([1, 1, 1, 1, 1, 2])
    name, none, at = np.array([5, 3, 3, 0, 9, 9]), np.array([0, 0, 0, 1, 0, 0], bool), np.array([2, 4, 4, 1, 1, 1])
    least, later = substring._least_places(h, w, name, none, at)
    assert sorted(later.tolist()) == [0, 3] and [tuple(x) for x in np.array([name, at]).T[least]] == [(3, 4), (9, 1), (9, 1)]


def test_substring_equal_ids(spark):
    t = " ".join(f"w{i}" for i in range(30))
    df = spark.createDataFrame([(5, t, "s", 1, "c"), (5, t, "s", 1, "c"), (None, t, "s", 1, "c")], SCHEMA)
    got = sorted((str(r.row.doc_id), r.n_removed) for r in substring.dedup(df).collect())
    assert got == [("5", 0), ("5", 0), ("None", 30)]
    assert substring.dedup(df.limit(0)).count() == 0


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, free, out = share * sum(sizes.values()), set(names), {}
    while free:
        level = left / sum(w[s] for s in free)
        full = [s for s in free if level * w[s] > most * sizes[s]]
        if not full:
            return out | {s: level * w[s] for s in free}
        for s in full:
            out[s] = most * sizes[s]
            left -= out[s]
            free.remove(s)
    return out


def test_mixing(spark):
    rnd = random.Random(9)
    rows = [(i, " ".join(["w"] * rnd.choice([0, 1, 5, 40, 300])), rnd.choice(["b", "a", "a", "a", "é", None, "Z"]), 1, "c") for i in range(600)]
    rows += [(None, "x y z", "a", 1, "c"), (3, None, "only null", 1, "c"), (4, "a b", "tiny", 1, "c"), (4, "a b", "tiny", 1, "c")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = mixing.plan(df, leaf=16).collect()
    assert len(got) == len(rows)
    sizes, taken, biggest, target = defaultdict(int), defaultdict(int), defaultdict(int), {}
    for r in got:
        sizes[r.source] += r.size
        taken[r.source] += r.size * r.copies
        biggest[r.source] = max(biggest[r.source], r.size)
        target[r.source] = r.target
        assert 0 <= r.copies <= 2
    want = brute_targets(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s]) and abs(taken[s] - want[s]) <= biggest[s]
    assert sorted(map(str, mixing.plan(df.repartition(7), leaf=16).collect())) == sorted(map(str, got))
    mixed = mixing.apply(df, leaf=16)
    assert mixed.columns == df.columns
    assert mixed.count() == sum(r.copies for r in got)
    assert mixing.plan(df.limit(0)).count() == 0


def test_pivot_keeps_expectations():
    """Over many seeds each unit is taken as often as its probability says."""
    n, hits = 400, np.zeros(4)
    for seed in range(n):
        units = [[0.3, 10, 11], [0.6, 30, 22], [0.5, 5, 33], [0.25, 80, 44]]
        words = sum(p * s for p, s, _ in units)
        held = units[0]
        for u in units[1:]:
            if held[0] in (0.0, 1.0):
                held = u
                continue
            mixing.pivot(held, u, seed)
            assert sum(p * s for p, s, _ in units) == pytest.approx(words)
            held = u if held[0] in (0.0, 1.0) else held
        hits += [p for p, _, _ in units]
    assert np.abs(hits / n - [0.3, 0.6, 0.5, 0.25]).max() < 0.09


def test_equal_rows_are_dealt_to_many_leaves(spark, monkeypatch):
    """A third of all rows, or all of them, equal: no leaf holds more than two leaves' rows, and the words are kept."""
    sizes, plain = [], mixing.stash

    def counted(frame, what, **kw):
        out = plain(frame, what, **kw)
        if what == "pivots":
            sizes.append(sorted(r["count"] for r in out.groupBy("rank", "leaf").count().collect()))
        return out

    monkeypatch.setattr(mixing, "stash", counted)
    df = spark.range(60_000).selectExpr("7L AS doc_id", "'a' AS source", "'one two three' AS text")
    rows = mixing.plan(df, share=1.5, leaf=500)
    got = rows.groupBy("u").agg({"copies": "sum", "*": "count"}).collect()
    assert len(got) == 1 and got[0]["count(1)"] == 60_000 and abs(got[0]["sum(copies)"] - 90_000) <= 1
    assert len(sizes[0]) > 60 and sizes[0][-1] <= 5 * 500
    assert rows.agg({"copies": "max"}).first()[0] == 2
