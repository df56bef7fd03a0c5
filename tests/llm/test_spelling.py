"""Spelling variants against plain Python: every pair of words compared."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tessera.llm import spelling


def plain_words(rows, least=6, often=5, slip=None):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{run}".encode())
            if slip and h % slip == 0 and len(run) >= least:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += len(run) >= least
    return {w: k for w, k in n.items() if k >= often}


def one_apart(a, b):
    """By an edit table, unlike the operator."""
    if abs(len(a) - len(b)) > 1:
        return False
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1] == 1


def plain_variants(counts, ratio=5):
    found = {a: [b for b in counts if one_apart(a, b)] for a in counts}
    form = {}
    for a, others in found.items():
        best = min(others, key=lambda b: (-counts[b], b), default=None)
        form[a] = best if best is not None and counts[best] >= ratio * counts[a] else None
    out = {}
    for a in counts:
        root = a
        while form[root] is not None:
            root = form[root]
        out[a] = (form[a], root, counts[a], len(found[a]), form[a] and counts[form[a]])
    return out


def some_counts(n, seed=1):
    """Words of few letters, so that many are near, with chains of falling numbers and ties."""
    rnd, counts = random.Random(seed), {}
    while len(counts) < n:
        w = "".join(rnd.choice("aabénXß") for _ in range(rnd.randint(4, 8))) + rnd.choice(["", "ation", "ungen"])
        for k in range(rnd.randint(1, 4)):
            counts.setdefault(w, rnd.choice([5, 5, 30, 40, 200, 1000, 7000]))
            i = rnd.randrange(len(w))
            w = w[:i] + rnd.choice(["", "a", "bé"[rnd.randint(0, 1)] + w[i]]) + w[i + 1 :]
    return counts


def as_dict(df):
    rows = df.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("crowd", [2048, 12, 2])
def test_variants_against_all_pairs(spark, crowd):
    """Whole groups, groups by halves, and blocks of these give the same: the plain result."""
    counts = some_counts(260) | {"": 5, "a": 30, "ab": 200, "b": 6, "abc" * 100: 5, "abc" * 99 + "ab": 50}
    df = spark.createDataFrame([*counts.items(), (None, 3), ("ab", None)], "word string, n long")
    got = as_dict(spelling.variants(df, crowd=crowd))
    want = plain_variants(counts)
    assert got == want
    assert sum(f is not None for f, *_ in want.values()) > 50 and max(k for *_, k, _ in want.values()) > 2
    assert any(f is not None and r != f for f, r, *_ in want.values())


def test_words_and_slips(spark):
    rnd = random.Random(2)
    pool = ["straßen", "Ääääää", "Window", "windows", "été", "naïveté", "x" * 3000, "données", "ÀÈÌÒÙÝ", "multiply×divide"]
    rows = [(i, " ".join(rnd.choice(pool) + rnd.choice([".", "7", "", "_", "\n"]) for _ in range(rnd.randint(0, 60)))) for i in range(400)]
    rows += [(None, "Window Window"), (1, None), (2, ""), (3, rows[3][1]), (3, rows[3][1])]
    df = spark.createDataFrame([(*r, "x", None) for r in rows], "doc_id long, text string, word string, n int")
    for slip in (None, 199, 3):
        got = {r.word: r.n for r in spelling.words(df, slip=slip).collect()}
        assert got == plain_words(rows, slip=slip) and got
    assert spelling.variants(spelling.words(df.limit(0), slip=199)).count() == 0
    assert as_dict(spelling.variants(spelling.words(df, slip=3))) == plain_variants(plain_words(rows, slip=3))


def test_equal_counts_sum_up(spark):
    df = spark.createDataFrame([("letters", 20), ("letters", 5), ("leters", 5)], "word string, n long")
    assert as_dict(spelling.variants(df)) == {"letters": (None, "letters", 25, 1, None), "leters": ("letters", "letters", 5, 1, 25)}


def test_masks():
    """One edit flips two bits at most, so a band stays; anagrams have one mask."""
    rnd = random.Random(3)
    for _ in range(2000):
        w = "".join(rnd.choice("abcdefghijklmnopqrstuvwxyzßéñ÷") for _ in range(rnd.randint(1, 12)))
        i, c = rnd.randrange(len(w)), rnd.choice("abcxyzé")
        for v in (w[:i] + w[i + 1 :], w[:i] + c + w[i:], w[:i] + c + w[i + 1 :]):
            a, b = spelling.masks([w, v]).tolist()
            assert bin(a ^ b).count("1") <= 2
            assert any((a ^ b) >> (21 * k) & ((1 << 21) - 1) == 0 for k in range(3))
            assert spelling.near(w, v) == one_apart(w, v) == spelling.near(v, w)
    assert np.unique(spelling.masks(["listen", "silent", "enlist"])).size == 1
