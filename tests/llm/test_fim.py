"""Fill-in-the-middle against plain Python on odd texts, and its automaton by itself."""

import hashlib
import random

import numpy as np
import pytest

from tessera.llm import fim

ODD = [None, "", "<", "<P", "<P>", "a<<M>b", "<<S", "é", "日本", "😀<", "\x00\x7f", "P>S>M>", "word " * 400, "é日😀<" * 90_000]


def odd_texts(n=400):
    rnd = random.Random(7)
    sizes = [0, 1, 2, 3, 5, 60, 254, 255, 256, 257, 258, 700, 1500]
    return ODD + ["".join(rnd.choice("ab <PSM>é日😀") for _ in range(rnd.choice(sizes))) for _ in range(n)]


def plainly(doc_id, text, seed=1, percent=90, spm=20):
    t = text or ""
    digest = hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(t)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not t or any(s in t for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= percent:
        return n, "plain", None, None, t
    if h4 % 100 < spm:
        return n, "spm", a, b - a, f"<S>{t[b:]}<P>{t[:a]}<M>{t[a:b]}"
    return n, "psm", a, b - a, f"<P>{t[:a]}<S>{t[b:]}<M>{t[a:b]}"


def test_outputs_against_plain_python(spark):
    """Nulls in any column, repeated rows, clashing names, texts longer than a slice; and the way back."""
    rows = [(i, t, "x", None, i) for i, t in enumerate(odd_texts())] + [(None, "null id", None, 1, -1), (3, "again", "p", 1, -2), (3, "again", "p", 1, -2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, form string, output int, row long")
    out = fim.transform(df).withColumn("back", fim.restore("output", "form")).collect()
    assert len(out) == len(rows)
    for r in out:
        n, form, a, m, said = plainly(r.row.doc_id, r.row.text)
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (n, form, a, m)
        assert bytes(r.output).decode() == said and bytes(r.back).decode() == (r.row.text or "")
    assert {r.form for r in out} == {"plain", "psm", "spm"}
    assert sorted(map(str, (r.row for r in out))) == sorted(map(str, df.collect()))
    assert fim.transform(df.limit(0)).count() == 0


def test_seeds_and_shares(spark):
    df = spark.range(3000).selectExpr("id AS doc_id", "concat('text number ', id) AS text")
    forms = lambda **k: {r.row.doc_id: (r.form, bytes(r.output)) for r in fim.transform(df, **k).collect()}
    one = forms()
    assert one == forms() and one != forms(seed=2)
    assert abs(sum(f == "plain" for f, _ in one.values()) - 300) < 80 and abs(sum(f == "spm" for f, _ in one.values()) - 540) < 100
    assert {f for f, _ in forms(percent=0).values()} == {"plain"} and {f for f, _ in forms(percent=100, spm=100).values()} == {"spm"}


def test_bytes_that_are_not_utf8(spark):
    """They are kept; each byte that continues nothing is a unit."""
    df = spark.sql("SELECT 5L AS doc_id, cast(X'6180E3816280FF62' AS STRING) AS text")
    r = fim.transform(df, percent=100).withColumn("back", fim.restore("output", "form")).first()
    assert r.n == 7 and bytes(r.back) == bytes.fromhex("6180E3816280FF62")


@pytest.mark.parametrize("sentinels", [("<P>", "<S>", "<M>"), ("日前", "尾", "中間"), ("<|fim_prefix|>", "<|fim_suffix|>", "<|fim_middle|>")])
def test_automaton(sentinels):
    """Counts, sentinels and places, whatever lane a character or a sentinel crosses."""
    machine, rnd = fim.automaton(sentinels), random.Random(3)
    texts = ["x" * k + s + "é" * 300 for k in range(240, 258) for s in sentinels] + ["日" * 200 + sentinels[0][:-1], ""]
    texts += ["".join(rnd.choice("a日中尾<|>") for _ in range(rnd.randint(0, 900))) for _ in range(200)]
    for t, (counts, hit) in zip(texts, machine.scan([t.encode() for t in texts])):
        running = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
        assert running[-1] == len(t) and hit == any(s in t for s in sentinels)
        for unit in {0, len(t) // 3, max(0, len(t) - 1), len(t)}:
            assert machine.locate(t.encode(), running, unit) == len(t[:unit].encode())


@pytest.mark.parametrize("bad", [("", "<S>", "<M>"), ("aba", "<S>", "<M>"), ("<P>", "P>x", "<M>"), ("<P>", "x<P>x", "<M>")])
def test_sentinels_that_could_be_mistaken_are_refused(bad):
    with pytest.raises(ValueError):
        fim.Automaton(tuple(s.encode() for s in bad))
