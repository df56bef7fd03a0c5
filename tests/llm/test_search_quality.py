"""BM25 search against brute force; the classifier's held-out accuracy; the pipeline's stages."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from test_dedup_mix import brute_components, brute_substring, brute_targets
from test_tokens import brute_repeats

import corpus_pipeline
from tessera.llm import bm25, factorisation, repetition

SF = "/root/testdata/sf0.001"


def brute(rows, asked, k):
    words = {i: Counter("".join(c.lower() if c.isascii() else c for c in t or "").encode().split()) for i, t in rows}
    n, mean = len(rows), sum(sum(c.values()) for c in words.values()) / len(rows)
    df = Counter(w for c in words.values() for w in c)
    out = {}
    for q in asked:
        scored = []
        for i, c in words.items():
            norm = 1.2 * (0.25 + 0.75 * sum(c.values()) / mean)
            s = sum(m * math.log1p((n - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * 2.2 / (c[w] + norm) for w, m in words[q].items() if w in c)
            if s:
                scored.append((-round(s, 9), i))
        out[q] = [(i, -s) for s, i in sorted(scored)[:k]]
    return out


@pytest.mark.parametrize(("shard", "per_pass"), [(500, 3), (1 << 20, 4096)])
def test_bm25(spark, shard, per_pass):
    rnd = random.Random(1)
    vocab = [f"w{int(rnd.paretovariate(0.6)) % 300}" for _ in range(500)]
    rows = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.choice([0, 1, 5, 30, 90])))) for i in range(400)]
    rows += [(400, None), (401, rows[7][1]), (402, rows[7][1].upper())]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumnRenamed("doc_id", "id").selectExpr("id", "text", "id AS doc_id", "1 AS score").repartition(3)
    got = {}
    for r in bm25.search(df, df.filter("id % 20 = 0"), k=5, id_col="id", shard=shard, per_pass=per_pass).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.doc_id, r.score))
    want = {q: v for q, v in brute(rows, [i for i, _ in rows if i % 20 == 0], 5).items() if v}
    assert set(got) == set(want)
    for q, v in want.items():
        found = sorted(got[q])
        assert [i for _, i, _ in found] == [i for i, _ in v]
        assert [s for _, _, s in found] == pytest.approx([s for _, s in v])
    assert bm25.search(df.limit(0), df, id_col="id").count() == 0


def test_bm25_odd_queries(spark):
    """Different texts under one id are queries of their own, equal ones one query; long texts; no id."""
    rnd = random.Random(3)
    long = " ".join(f"w{rnd.randrange(5000)}" for _ in range(100_000))
    rows = [(1, "a b c"), (2, "b c d"), (3, "x y"), (3, "x y"), (4, long), (None, "a x"), (5, "q"), (6, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    asked = spark.createDataFrame([(7, "a"), (7, "x"), (7, "x"), (8, None), (None, "q"), (9, long)], "doc_id long, text string")
    got = sorted((str(r.query_id), r["rank"], str(r.doc_id)) for r in bm25.search(df, asked, k=3).collect())
    assert got == sorted([("7", 1, "None"), ("7", 2, "1"), ("7", 1, "3"), ("7", 2, "3"), ("7", 3, "None"), ("None", 1, "5"), ("9", 1, "4")])


def test_bm25_later_shards_return_few_rows(spark, monkeypatch):
    """Rows that shards return do not grow with queries times shards; copies that tie with the k-th neither."""
    rnd = random.Random(4)
    rows = [(i, " ".join(f"w{int(rnd.paretovariate(0.7)) % 2000}" for _ in range(40))) for i in range(900)]
    rows += [(900 + i, rows[i % 3][1]) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    returned, plain = [], bm25.stash

    def counted(frame, what, **kw):
        out = plain(frame, what, **kw)
        if what == "best":
            returned.append(out.count())
        return out

    monkeypatch.setattr(bm25, "stash", counted)
    got = {}
    asked = df.filter("doc_id % 30 = 0")
    for r in bm25.search(df, asked, k=5, shard=5000).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.doc_id))
    assert len(returned) >= 3
    want = brute(rows, [i for i, _ in rows if i % 30 == 0], 5)
    assert {q: [d for _, d in sorted(v)] for q, v in got.items()} == {q: [d for d, _ in v] for q, v in want.items()}


def test_bm25_rare_terms_seed_the_threshold():
    rnd = random.Random(2)
    texts = [" ".join(f"w{int(rnd.paretovariate(0.6)) % 900}" for _ in range(rnd.choice([1, 30, 90]))).encode() for _ in range(700)]
    s = bm25.Shard(list(range(len(texts))), texts)
    s.weigh(float(s.length.mean()))
    seeded = 0
    for q in range(0, len(texts), 7):
        t, n, _ = bm25.terms(texts[q])
        at = np.searchsorted(s.terms, t)
        idf = n * np.log1p((len(texts) + 0.5) / (np.diff(s.start)[at] + 0.5))
        score = np.zeros(len(texts))
        for a, w in zip(at, idf):
            own = slice(s.start[a], s.start[a + 1])
            score[s.row[own]] += w * s.weight[own]
        want = sorted((-round(x, 9), i) for i, x in enumerate(score) if x)[:5]
        assert [i for _, i in s.top(t, idf, 5)] == [i for _, i in want]
        assert [i for _, i in s.top(t, idf, 5, -want[2][0] if len(want) > 2 else 0)][:3] == [i for _, i in want[:3]]
        assert s.top(t, idf, 5, -2 * want[0][0]) == [] and not s.asked.any()
        low = s.seed(at, idf, 5)
        assert low <= (-want[4][0] + 1e-8 if len(want) == 5 else 0)
        seeded += low > 0
    assert seeded > 50


def test_bm25_blocks_below_the_threshold_are_not_scored():
    """Rows of two vocabularies: with the k-th score known, the blocks of the other one are not read."""
    rnd = random.Random(5)
    texts = [" ".join(f"{'ab'[i % 2]}{int(rnd.paretovariate(0.5)) % 900}" for _ in range(rnd.choice([20, 60, 200]))).encode() for i in range(2000)]
    texts[7::100] = [texts[7]] * 20  # more copies than k
    s = bm25.Shard(list(range(2000)), texts, gather=True)
    s.weigh(float(s.length.mean()))
    plain, read = s.table, []

    class Counted:
        def __len__(self):
            return len(plain)

        def __getitem__(self, b):
            read.append(b)
            return plain[b]

    s.table, warm = Counted(), []
    for q in range(0, 300, 7):
        t, n, _ = bm25.terms(texts[q])
        at = s.find(t)
        idf = n * np.log1p((2000 + 0.5) / (np.diff(s.start)[at] + 0.5))
        score = np.zeros(2000)
        for a, w in zip(at, idf):
            own = slice(s.start[a], s.start[a + 1])
            score[s.row[own]] += w * s.weight[own]
        want = sorted((-round(x, 9), s.ids[i]) for i, x in enumerate(score) if x)[:10]
        for least in (0.0, -want[-1][0]):
            read.clear()
            found = list(s.tops([(at, idf, least), (at[:0], idf[:0], 0.0), (at, idf, least)], 10))
            assert [s.ids[r] for _, r in found[0]] == [i for _, i in want] and found[1] == [] and found[2] == found[0]
            assert [x for x, _ in found[0]] == pytest.approx([-x for x, _ in want], abs=1e-8)
        warm.append(len(read))
    assert sum(warm) < 0.55 * len(plain) * len(warm), sum(warm) / len(plain) / len(warm)


def test_machine_interactions_in_linear_time():
    """The sum-of-squares identity equals the sum over pairs."""
    rng = np.random.default_rng(0)
    m = factorisation.Machine(0.3, rng.normal(size=50), rng.normal(size=(50, 4)))
    at, x = np.array([3, 7, 9, 40, 2]), rng.normal(size=5)
    edge = np.array([0, 3])
    want = []
    for a, z in ((0, 3), (3, 5)):
        pair = sum(m.v[at[i]] @ m.v[at[j]] * x[i] * x[j] for i in range(a, z) for j in range(i + 1, z))
        want.append(0.3 + m.w[at[a:z]] @ x[a:z] + pair)
    assert np.allclose(m.raw(at, x, edge), want)


def test_most_frequent_word_of_the_whole_text():
    words = [b"w%d" % i for i in range(800)]
    words[1::10] = [b"x"] * 80
    want = factorisation.structure(b" ".join(words), words)
    assert want[-1] == 0.1
    for seed in range(20):
        random.Random(seed).shuffle(words)
        assert factorisation.structure(b" ".join(words), words)[-1] == 0.1


def test_classifier_held_out(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = factorisation.classify(docs, labels).selectExpr("row.doc_id", "held_out", "score", "predicted").collect()
    assert len(rows) == docs.count()
    y = {r.doc_id: r.quality for r in labels.collect()}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    out = [(r.predicted, y[r.doc_id]) for r in rows if r.held_out and r.doc_id in y]
    assert np.mean([p == q for p, q in out]) > 0.93
    flipped = labels.selectExpr("doc_id", "CASE WHEN pmod(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)), 4) = 2 THEN 1 - quality ELSE quality END AS quality")
    again = factorisation.classify(docs, flipped).selectExpr("row.doc_id", "score").collect()
    assert {r.doc_id: r.score for r in again} == {r.doc_id: r.score for r in rows}


def test_classifier_odd_rows(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, "", "b"), (None, "x " * 5000, "c")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, None), (1, 1), (1, 0)], "doc_id long, quality int")
    assert factorisation.classify(df, labels).count() == 3
    assert {r.score for r in factorisation.classify(df, labels.limit(0)).collect()} == {0.5}


def test_classifier_does_not_depend_on_partitions(spark):
    """Ids with several texts and metadata: equal scores from any partitioning; and no rows from none."""
    rnd = random.Random(8)
    rows = [(i % 60, " ".join(rnd.choice("ab cd ef gh ij kl".split()) for _ in range(30)), i % 7) for i in range(240)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    tables = []
    for parts in (1, 3, 7):
        rnd.shuffle(rows)
        df = spark.createDataFrame(rows, "doc_id long, text string, size int").repartition(parts)
        tables.append(sorted((r.row.doc_id, r.row.text, r.score) for r in factorisation.classify(df, labels, metadata=["size"]).collect()))
    assert tables[0] == tables[1] == tables[2] and len({s for *_, s in tables[0]}) > 1
    assert factorisation.classify(df.limit(0), labels).count() == 0


def test_fit_against_plain_python():
    """Two epochs of AdaGrad on the logistic loss, feature by feature."""
    rng = np.random.default_rng(1)
    rows = [(np.array([3, 70 + i % 4, 9]), np.array([0.5, 1.0, 0.25 * (i % 3)])) for i in range(12)]
    y, weight = np.array([i % 2 for i in range(12)], float), np.linspace(0.5, 1.5, 12)
    got = factorisation.fit(rows, y, weight, rank=3, epochs=2)
    size = factorisation.HASHED + factorisation.STRUCTURE + factorisation.METADATA
    rng = np.random.default_rng(7)
    b, w, v = 0.0, np.zeros(size), rng.normal(0, 0.02, (size, 3))
    gb, gw, gv = 1e-6, np.full(size, 1e-6), np.full((size, 3), 1e-6)
    for _ in range(2):
        order = rng.permutation(12)
        db, dw, dv = 0.0, {}, {}
        for i in order:
            at, x = rows[i]
            z = b + sum(w[j] * u for j, u in zip(at, x))
            z += sum((v[at[p]] @ v[at[q]]) * x[p] * x[q] for p in range(3) for q in range(p))
            g = (1 / (1 + math.exp(-z)) - y[i]) * weight[i] / 12
            db += g
            for p in range(3):
                dw[at[p]] = dw.get(at[p], 0) + g * x[p]
                dv[at[p]] = dv.get(at[p], 0) + g * x[p] * sum(v[at[q]] * x[q] for q in range(3) if q != p)
        for j in dw:
            a, c = dw[j] + 1e-5 * w[j], dv[j] + 1e-5 * v[j]
            gw[j] += a * a
            gv[j] += c * c
            w[j] -= 0.1 * a / math.sqrt(gw[j])
            v[j] -= 0.05 * c / np.sqrt(gv[j])
        gb += db * db
        b -= 0.1 * db / math.sqrt(gb)
    assert np.isclose(got.bias, b) and np.allclose(got.w, w) and np.allclose(got.v, v)


def test_classifier_learns_from_metadata(spark):
    """Equal texts whose labels only the metadata tell apart."""
    rows = [(i, "same words in each", ["good", "bad"][i % 2], [700.0, -0.5][i % 2], None) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kind string, size double, none string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(200)], "doc_id long, quality int")
    for metadata in (["kind"], ["size"], ["none", "kind", "size"]):
        got = factorisation.classify(df, labels, metadata=metadata, epochs=20).collect()
        assert all(r.predicted == 1 - r.row.doc_id % 2 for r in got) and any(r.held_out for r in got)
    assert len({r.score for r in factorisation.classify(df, labels, metadata=["none"]).collect()}) == 1


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, [docs.count()]
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, frames[-1], SF)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == columns and out.dtypes == docs.dtypes
        frames.append(out.cache())
        seen.append(frames[-1].count())
    assert seen[0] > seen[1] > 0 and seen[1] >= seen[2] >= seen[3] and seen[4] == seen[5]
    kept = {r.doc_id for r in frames[1].collect()}
    for r in docs.collect():
        s = repetition.measure([r.text.encode()], (5, 7, 10))[0]
        if s["n_words"] >= 10 and not any(s["covered_chars"]) and not s["dup_line_chars"]:
            assert r.doc_id in kept
    assert all(r.n_chars == len(r.text) for r in frames[3].collect())


def planted():
    """Texts with exact and near copies, shared passages, repetitions, and neither words nor text."""
    rnd = random.Random(5)
    words = lambda n: [f"{rnd.choice('abcdefghij')}{rnd.randrange(10**4):04}" for _ in range(n)]
    texts = [words(rnd.randint(30, 120)) for _ in range(40)]
    for i in (0, 1, 2):  # exact copies, copies over and under a similarity of 0.8
        texts += [texts[i], list(texts[i])]
        for n in (1, 9):
            near = list(texts[i])
            for k in range(n):
                near[k * len(near) // n] = "changed"
            texts.append(near)
    passage, said = words(45), words(22)
    texts += [words(20) + passage + words(k) for k in (5, 30, 60)] + [words(12) + passage[8:33] + words(50), passage[:24]]
    texts += [words(206) + said + said, words(260) + said + said, words(90) + said + said, words(9), words(10)]
    line = words(9)
    texts += [[*line, "\n", *words(80), "\n", *line], [*line, "\n", *line, "\n", *line, *words(30)], ["same"] * 60, [w for w in words(14) for _ in range(4)]]
    texts = [re.sub(" ?\n ?", "\n", " ".join(t)) for t in texts] + ["", " \n ", None]
    rnd.shuffle(texts)
    return [(3 * i, t, ["web", "books", "code", None][i % 4], len(t or "")) for i, t in enumerate(texts)]


def plainly_clean(t):
    words = [w.decode() for w in (t or "").encode().split()]
    lines = [x for x in (t or "").split("\n") if x.strip()]
    again = [x for k, x in enumerate(lines) if x in lines[:k]]
    chars = sum(map(len, words))
    if len(words) < 10 or 100 * len(brute_repeats(words, 5)) > 20 * len(words) or 100 * sum(map(len, again)) > 30 * chars:
        return False
    covered = {n: sum(len(words[k]) for k in brute_repeats(words, n)) for n in (3, 5, 7, 10)}
    return all(100 * covered[n] <= most * chars for n, most in ((3, 40), (5, 20), (7, 18), (10, 16)))


def test_pipeline_against_plain_python(spark, tmp_path):
    schema = "doc_id long, text string, source string, n_chars long"
    spark.createDataFrame(planted(), schema).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    frames = [spark.read.parquet(str(tmp_path / "documents.parquet"))]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(stage(spark, frames[-1], str(tmp_path)).cache())
    got = [sorted(map(tuple, f.select(*frames[0].columns).collect()), key=lambda r: r[0]) for f in frames[1:5]]

    want = [r for r in planted() if plainly_clean(r[1])]
    assert got[0] == want and 40 < len(want) < len(planted()) - 5
    root, _ = brute_components([r[1] for r in want], 5, 80)
    want = [r for k, r in enumerate(want) if root[k] == k]
    assert got[1] == want and len(got[0]) - len(want) == 9
    gone = brute_substring([(r[0], r[1].encode().split()) for r in want], 20)
    left = []
    for i, t, source, n in want:
        parts = re.findall(r"\S+\s*", t)
        kept = "".join(x for k, x in enumerate(parts) if k not in gone[i])
        if kept:
            left.append((i, kept, source, len(kept)))
    assert got[2] == left and len(left) == len(want) - 1 and sum(map(bool, gone.values())) >= 4

    sizes, taken, biggest = defaultdict(int), defaultdict(int), defaultdict(int)
    for _, t, source, _ in left:
        sizes[source] += len(t.split())
        biggest[source] = max(biggest[source], len(t.split()))
    for _, t, source, _ in got[3]:
        taken[source] += len(t.split())
    copies = Counter(got[3])
    assert set(copies) <= set(left) and max(copies.values()) == 2
    assert all(abs(taken[s] - aim) <= biggest[s] for s, aim in brute_targets(sizes).items())

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    tokens = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
    sha = lambda b: hashlib.sha256(b).hexdigest()
    ids = [(i, tokens.encode_ordinary(t), t) for i, t, _, _ in got[3]]
    coded = sorted((i, len(x), sha(",".join(map(str, x)).encode()), sha(t.encode())) for i, x, t in ids)
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    for out in (frames[5], corpus_pipeline.run(spark, str(tmp_path))):
        assert sorted(map(tuple, out.select(*names).collect())) == coded


def test_pipeline_on_odd_tables(spark):
    """Extra columns whose names the stages use inside, null ids and sources, repeated rows; and no rows."""
    rnd = random.Random(11)
    words = lambda n: " ".join(f"v{rnd.randrange(10**6)}" for _ in range(n))
    same, long = words(60), words(30_000)
    rows = [(None, same, None), (None, same, None), (1, same, "a"), (2, long, "a"), (2, words(40), "b"), (3, "", "a"), (4, None, None), (5, words(25), "a")]
    clash = ["row", "_id", "_m", "c", "k", "n", "label", "root", "_c", "_k", "kept", "n_words", "starts", "_nth"]
    schema = "doc_id long, text string, source string, n_chars long, " + ", ".join(f"{x} int" for x in clash)
    df = spark.createDataFrame([(*r, len(r[1] or ""), *range(len(clash))) for r in rows], schema)
    frame = df
    some = [(1, 60), (2, 40), (2, 30_000), (5, 25)]
    want = {"quality rules": [*some, (None, 60), (None, 60)], "near duplicates": some, "substring dedup": some}
    for name, stage in corpus_pipeline.STAGES[:4]:
        frame = spark.createDataFrame(stage(spark, frame, "").collect(), schema)
        if name in want:
            assert sorted(((r.doc_id, len(r.text.split())) for r in frame.collect()), key=str) == sorted(want[name], key=str), name
        assert frame.columns == df.columns, name
        assert all(tuple(r)[4:] == tuple(range(len(clash))) for r in frame.collect())
        assert stage(spark, df.limit(0), "").count() == 0
    left = Counter((r.doc_id, len(r.text.split())) for r in frame.collect())
    # Source b is at its limit of two copies; a's texts come once or twice, and its words near 45,107.5.
    assert set(left) == set(some) and left[2, 40] == 2 and set(left.values()) <= {1, 2}
    assert abs(sum(n * k for (_, n), k in left.items()) - 80 - 45_107.5) <= 30_000
    name, stage = corpus_pipeline.STAGES[4]
    assert stage(spark, frame, "").count() == frame.count() and stage(spark, df.limit(0), "").count() == 0
