"""The shape of JSON columns: types of paths as a mergeable aggregate, and frequent paths as typed columns.

Each value of a path is of a kind, and kinds are bits: those of a path are or-ed together, in a task, between tasks and
between runs, in any order. A path's type is read off its bits: the widest of the numbers, or its only kind, or, where
kinds do not go together, JSON text. A path is the keys of objects from the root, escaped and joined by dots; elements
of arrays are not paths of their own, an array is one value.
"""

from __future__ import annotations

import json
import math
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.relational import _must_be_new, _quoted

NULL, BOOLEAN, LONG, DOUBLE, TEXT, OBJECT, ARRAY, OTHER = (1 << k for k in range(8))
#: What cannot be read as JSON is of this path.
BROKEN = "!"


def escaped(key: str) -> str:
    """A key as part of a path: dots and backslashes behind a backslash, an empty key as backslash e."""
    return key.replace("\\", "\\\\").replace(".", "\\.").replace("!", "\\!") or "\\e"


def kind(value) -> int:
    if value is None:
        return NULL
    if isinstance(value, bool):
        return BOOLEAN
    if isinstance(value, int):
        return LONG if -(1 << 63) <= value < 1 << 63 else OTHER
    if isinstance(value, float):
        return DOUBLE if math.isfinite(value) else OTHER
    return TEXT if isinstance(value, str) else OBJECT if isinstance(value, dict) else ARRAY


def read(text: str):
    """The value of a JSON text; raises ValueError for what is not JSON, is too deep, or says a key twice, which no
    typed column could give back."""

    def pairs(found):
        out = dict(found)
        if len(out) < len(found):
            raise ValueError("a key that is there twice")
        return out

    try:
        value = json.loads(text, object_pairs_hook=pairs)
    except RecursionError as e:
        raise ValueError("too deep") from e
    if "\\ud" in text.lower():  # half a surrogate pair is no text
        json.dumps(value, ensure_ascii=False).encode()
    return value


def paths(value, at: str = "") -> Iterator[tuple[str, object]]:
    """(path, value) of every key of nested objects, the root's path being empty."""
    todo = [(at, value)]
    while todo:
        path, v = todo.pop()
        yield path, v
        if isinstance(v, dict):
            todo += [(f"{path}.{escaped(k)}" if path else escaped(k), x) for k, x in v.items()]


def shapes(df: DataFrame, column: str) -> DataFrame:
    """(path, bits, n) of every path of a JSON column: its kinds, and in how many rows it is. The root's path is
    empty; texts that are not JSON are of the path "!". Null texts have no path; each task adds up what it meets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def packed():
            out = pa.RecordBatch.from_arrays([pa.array([p for p, _ in seen], pa.string()), pa.array([k for _, k in seen], pa.int32()), pa.array(list(seen.values()), pa.int64())], ["path", "kind", "n"])
            seen.clear()
            return out

        for batch in batches:
            for text, many in Counter(batch.column(0).to_pylist()).items():
                if text is None:
                    continue
                try:
                    for path, value in paths(read(text)):
                        seen[path, kind(value)] += many
                except ValueError:
                    seen[BROKEN, OTHER] += many
            if len(seen) > 10_000:
                yield packed()
        if seen:
            yield packed()

    counted = df.select(_quoted(column).cast("string").alias("text")).mapInArrow(run, "path string, kind int, n long")
    return counted.groupBy("path").agg(F.bit_or("kind").alias("bits"), F.sum("n").alias("n"))


def merged(*found: DataFrame) -> DataFrame:
    """The shapes of several runs as one."""
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.groupBy("path").agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n"))


def type_of(bits: Column) -> Column:
    """The type that the values of a path fit, as Spark names it: void if they are all null, and for kinds that do not
    go together, "json"."""
    real = bits.bitwiseAND(F.lit(~NULL))
    out = F.when(real == 0, "void").when(real == BOOLEAN, "boolean").when(real == LONG, "bigint").when(real.isin(DOUBLE, LONG | DOUBLE), "double")
    return out.when(real == TEXT, "string").when(real == OBJECT, "object").when(real == ARRAY, "array").otherwise("json")


_ARROW = {"boolean": pa.bool_(), "bigint": pa.int64(), "double": pa.float64(), "string": pa.string(), "json": pa.string()}
_KINDS = {"boolean": BOOLEAN, "bigint": LONG, "double": DOUBLE | LONG, "string": TEXT}


def frequent(found: DataFrame, rows: int, share: float = 0.1, most: int = 1000) -> list[tuple[str, str]]:
    """(path, type) of the paths that are in at least `share` of the rows and hold values of one type, the most
    frequent `most` of them: they become columns, so there cannot be more of them than a table can have."""
    typed = found.withColumn("type", type_of(F.col("bits"))).filter((F.col("n") >= share * rows) & (F.length("path") > 0) & F.col("type").isin(*_KINDS))
    return [(r.path, r.type) for r in typed.orderBy(F.desc("n"), "path").limit(most).collect()]


def _parts(path: str) -> list[str]:
    out, part, k = [], "", 0
    while k < len(path):
        c = path[k]
        if c == "\\":
            k += 1
            part += "" if path[k] == "e" and not part and path[k + 1 : k + 2] in ("", ".") else path[k]
        elif c == ".":
            out.append(part)
            part = ""
        else:
            part += c
        k += 1
    return [*out, part]


def shred(df: DataFrame, column: str, typed: Sequence[tuple[str, str]], names: Sequence[str] | None = None, rest: str = "rest") -> DataFrame:
    """df with a typed column for each (path, type), named after the path or by `names`, and `rest`: the JSON of what no
    column took. Values of another kind, integers that no double is equal to, and nulls stay in rest, and so does all of a
    text that is not JSON; so assembled() gives every value back. Nothing is left: rest is {}."""
    names = [p for p, _ in typed] if names is None else list(names)
    _must_be_new([*names, rest], df)
    if len({n.lower() for n in (*names, rest)}) <= len(names):
        raise ValueError("names that are there twice")
    wanted = [(_parts(p), _KINDS[t], t) for p, t in typed]
    schema = pa.struct([*((f"v{k}", _ARROW[t]) for k, (_, t) in enumerate(typed)), ("rest", pa.string())])

    def run(x: pa.Array) -> pa.Array:
        out = []
        for text in x.to_pylist():
            row: dict = {"rest": text}
            try:
                value = None if text is None else read(text)
            except ValueError:
                value = None
            if isinstance(value, dict):
                taken = False
                for k, (parts, kinds, t) in enumerate(wanted):
                    at = value
                    for p in parts[:-1]:
                        at = at.get(p) if isinstance(at, dict) else None
                    if isinstance(at, dict) and parts[-1] in at and kind(v := at[parts[-1]]) & kinds and (t != "double" or isinstance(v, float) or int(float(v)) == v):
                        row[f"v{k}"], taken = at.pop(parts[-1]), True
                if taken:
                    row["rest"] = json.dumps(value, ensure_ascii=False)
            out.append({k: float(v) if k != "rest" and typed[int(k[1:])][1] == "double" else v for k, v in row.items()})
        return pa.array(out, schema)

    kinds = ", ".join([*(f"v{k} {t}" for k, (_, t) in enumerate(typed)), "rest string"])
    made = df.withColumn("_shredded", F.arrow_udf(run, kinds)(_quoted(column).cast("string")))
    return made.select(*map(_quoted, df.columns), *[F.col(f"_shredded.v{k}").alias(n) for k, n in enumerate(names)], F.col("_shredded.rest").alias(rest))


def assembled(df: DataFrame, typed: Sequence[tuple[str, str]], names: Sequence[str] | None = None, rest: str = "rest", out: str = "json") -> DataFrame:
    """df with the JSON that shred() took apart: equal as a value, not as a text. Empty objects stay in rest."""
    _must_be_new([out], df)
    names = [p for p, _ in typed] if names is None else list(names)
    parts = [_parts(p) for p, _ in typed]

    def run(text: pa.Array, *columns: pa.Array) -> pa.Array:
        found = []
        for t, *values in zip(text.to_pylist(), *(c.to_pylist() for c in columns)):
            if any(v is not None for v in values):
                value = json.loads(t)
                for path, v in zip(parts, values):
                    if v is not None:
                        at = value
                        for p in path[:-1]:
                            at = at[p]
                        at[path[-1]] = v
                t = json.dumps(value, ensure_ascii=False)
            found.append(t)
        return pa.array(found, pa.string())

    return df.withColumn(out, F.arrow_udf(run, "string")(_quoted(rest), *map(_quoted, names)))
