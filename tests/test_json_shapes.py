"""JSON shapes and shredding against plain Python, on mixed and odd values."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import json_shapes as J

ODD = [None, "", "{}", "[]", "null", "3", '"x"', "{", '{"a": 1, "a": 2}', '{"a.b": 1, "": 2, "!": 3, "c\\\\d": {"": {"e": 4}}}', '{"s": "\\ud800"}', '{"s": "\\ud83d\\ude00"}', '{"n": NaN, "i": Infinity}', '{"big": 9223372036854775808, "long": 9223372036854775807}', '{"v0": 1, "rest": 2}', "[" * 100_000, '{"f": 9007199254740993}', '{"f": 0.5}', '{"f": 7}', ' {"f" : 1e3 } ']


def some_texts(n=400, seed=1):
    rnd = random.Random(seed)

    def value(deep):
        return rnd.choice([lambda: None, lambda: rnd.random() < 0.5, lambda: rnd.randrange(-9, 9), lambda: rnd.random(), lambda: rnd.choice(["", "x", "é😀"]), lambda: [1, "a"], lambda: {rnd.choice("ab.c"): value(deep - 1) for _ in range(3)} if deep else 0])()

    return ODD + [json.dumps({k: value(3) for k in rnd.sample(["a", "b", "c.d", "e", "int"], 3)} | {"int": rnd.randrange(9), "deep": {"er": {"num": rnd.choice([1, 2.5])}}}) for _ in range(n)]


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "id int, j string, v0 string").repartition(3)


def plain_shapes(texts):
    out = {}

    def walk(path, v):
        bits, n = out.get(path, (0, 0))
        out[path] = bits | J.kind(v), n + 1
        if isinstance(v, dict):
            for k, x in v.items():
                walk(f"{path}.{J.escaped(k)}" if path else J.escaped(k), x)

    for t in texts:
        if t is None:
            continue
        try:
            v = J.read(t)
        except ValueError:
            out["!"] = J.OTHER, out.get("!", (0, 0))[1] + 1
            continue
        walk("", v)
    return out


def test_shapes_merge(spark):
    """In one run, and in two that are merged."""
    texts = some_texts()
    want = plain_shapes(texts)
    as_dict = lambda df: {r.path: (r.bits, r.n) for r in df.collect()}
    assert as_dict(J.shapes(frame(spark, texts), "j")) == want and want["!"][1] == 5
    assert as_dict(J.merged(J.shapes(frame(spark, texts[:99]), "j"), J.shapes(frame(spark, texts[99:]), "j"))) == want
    assert J.shapes(frame(spark, texts).limit(0), "j").count() == 0


def test_types(spark):
    cases = {0: "void", J.NULL: "void", J.LONG: "bigint", J.LONG | J.NULL: "bigint", J.LONG | J.DOUBLE: "double", J.DOUBLE: "double", J.TEXT: "string", J.TEXT | J.LONG: "json", J.BOOLEAN | J.NULL: "boolean", J.OBJECT: "object", J.ARRAY | J.NULL: "array", J.OBJECT | J.ARRAY: "json", J.OTHER: "json"}
    rows = spark.createDataFrame([(b,) for b in cases], "bits int").select("bits", J.type_of(F.col("bits")).alias("t")).collect()
    assert {r.bits: r.t for r in rows} == cases


@pytest.mark.parametrize("share", [0.0, 0.3])
def test_what_is_shredded_can_be_put_together(spark, share):
    texts = some_texts()
    df = frame(spark, texts)
    typed = J.frequent(J.shapes(df, "j"), len(texts), share)
    assert ("int", "bigint") in typed and ("deep.er.num", "double") in typed and (share > 0 or ("a\\.b", "bigint") in typed)
    names = [f"column {k}" for k in range(len(typed))]
    out = J.shred(df, "j", typed, names)
    assert out.columns == ["id", "j", "v0", *names, "rest"]
    k = typed.index(("int", "bigint"))
    for r in J.assembled(out, typed, names).collect():
        try:
            want = None if r.j is None else J.read(r.j)
        except ValueError:
            assert r.rest == r.j == r.json
            continue
        assert (r.json is None) == (r.j is None)
        if want != want or "NaN" in (r.j or ""):
            assert "NaN" in r.json
        else:
            assert (json.loads(r.json) if r.json is not None else None) == want
        assert r[names[k]] == (want.get("int") if isinstance(want, dict) else None)
    assert J.shred(df.limit(0), "j", typed, names).count() == 0


def test_values_of_other_kinds_stay(spark):
    df = frame(spark, ['{"f": 9007199254740993}', '{"f": 7}', '{"f": "x"}', '{"f": true}', '{"f": null}', '{"f": 0.5, "g": 1}', "[1]"])
    rows = {r.id: (r.f, r.rest) for r in J.shred(df, "j", [("f", "double")]).collect()}
    assert rows == {0: (None, '{"f": 9007199254740993}'), 1: (7.0, "{}"), 2: (None, '{"f": "x"}'), 3: (None, '{"f": true}'), 4: (None, '{"f": null}'), 5: (0.5, '{"g": 1}'), 6: (None, "[1]")}
    for typed, names in (([("v0", "string")], None), ([("f", "double"), ("g", "double")], ["x", "X"])):
        with pytest.raises(ValueError):
            J.shred(df, "j", typed, names)
