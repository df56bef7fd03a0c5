"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(b + sum w_i x_i + 1/2 sum_f [(sum v_if x_i)^2 - sum (v_if x_i)^2]): the pairwise
interactions of all features at rank f, in time linear in the features of a text.

The model is fitted on the driver on at most 2 * `most` labelled rows (`most` of each label, those
with the least id hashes); the rows are weighted so that each label counts as often as it occurs.
Fitting is deterministic, however the rows are partitioned. Scoring reads every whole text.

Metadata are any columns of the table: a value is hashed with its column's name, a number by its sign and
power of two. A null has no feature. Each counts as much as a structure statistic.

Defined results: a null or empty text has the structure features of an empty text and is scored; with
no labelled rows every score is 0.5; of several labels of one id the least counts; null labels do not; of
several rows of one id the machine learns from the one whose text has the least hash; repeated rows are
scored alike; an empty table gives no rows. Other columns are carried unchanged.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.work import settle, tidy

HASHED, METADATA = 1 << 16, 1 << 12
REMEMBER = 150_000


class _Slots(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBER:
            self.clear()
        self[word] = k = zlib.crc32(word) & (HASHED - 1)
        return k


_slots = _Slots()


def structure(b: bytes, words: list[bytes]) -> list[float]:
    """Statistics in about 0 to 1; they are features HASHED, HASHED + 1, ..."""
    n, size = len(words), len(b) or 1
    lines = [x for x in b.split(b"\n") if x.strip()]
    share = lambda chars: (len(b) - len(b.translate(None, chars))) / size
    counts = Counter(words)
    return [
        1.0,
        np.log1p(n) / 10,
        min(size / (n or 1), 40) / 40,
        len(counts) / (n or 1),
        sum(a == z for a, z in zip(words, words[1:])) / (n or 1),
        min(1.0, 10 * share(b"#*$%&|<>")),
        min(1.0, 10 * share(b".,;:!?")),
        min(1.0, 10 * share(b"!?")),
        min(1.0, 5 * share(b"0123456789")),
        min(1.0, 3 * share(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")),
        min(1.0, len(lines) / (n or 1)),
        1 - len(set(lines)) / (len(lines) or 1),
        min(1.0, 5 * share(b"/@_=\\{}[]()+~^`\"'")),
        float(n < 20),
        max(counts.values(), default=0) / (n or 1),
    ]


STRUCTURE = len(structure(b"", []))


def described(columns: list[str], values: tuple) -> list[bytes]:
    """The metadata features of a row, as they are hashed."""
    out = []
    for c, v in zip(columns, values):
        if v is None:
            continue
        if isinstance(v, (int, float, Decimal)) and not isinstance(v, bool):
            v = float(v)
            v = f"{np.sign(v):+.0f}e{math.frexp(v)[1]}" if math.isfinite(v) else v
        out.append(f"\0{c}={v}".encode("utf-8", "replace"))
    return out


def features(text: bytes | None, meta: list[bytes] = ()) -> tuple[np.ndarray, np.ndarray]:
    """(feature numbers, values): distinct hashed words share a length of 1, then the structure and the
    metadata."""
    b = text or b""
    words = b.split()
    slots = np.unique(np.fromiter(map(_slots.__getitem__, words), np.int64, len(words)))
    value = np.full(len(slots), 1 / np.sqrt(len(slots) or 1))
    own = np.array([HASHED + STRUCTURE + (zlib.crc32(m) & (METADATA - 1)) for m in meta], np.int64)
    return np.concatenate([slots, HASHED + np.arange(STRUCTURE), own]), np.concatenate([value, structure(b, words), np.ones(len(own))])


@dataclass
class Machine:
    bias: float
    w: np.ndarray
    v: np.ndarray

    def raw(self, at: np.ndarray, x: np.ndarray, edge: np.ndarray) -> np.ndarray:
        """Of rows that begin at `edge` in the flat features (at, x); no row is empty."""
        vx = self.v[at] * x[:, None]
        pairs = np.add.reduceat(vx, edge) ** 2 - np.add.reduceat(vx * vx, edge)
        return self.bias + np.add.reduceat(self.w[at] * x, edge) + 0.5 * pairs.sum(axis=1)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _flat(rows: list[tuple[np.ndarray, np.ndarray]]):
    n = np.array([len(a) for a, _ in rows])
    return np.concatenate([a for a, _ in rows]), np.concatenate([x for _, x in rows]), np.cumsum(n) - n, n


def fit(rows: list, y: np.ndarray, weight: np.ndarray, rank: int = 8, epochs: int = 8, rate: float = 0.1, l2: float = 1e-5, seed: int = 7) -> Machine:
    """Logistic loss by AdaGrad on batches of 128 rows, in a fixed order."""
    rng = np.random.default_rng(seed)
    size = HASHED + STRUCTURE + METADATA
    m = Machine(0.0, np.zeros(size), rng.normal(0, 0.02, (size, rank)))
    if not len(rows):
        return Machine(0.0, np.zeros(size), np.zeros((size, rank)))
    gw, gv, gb = np.full(size, 1e-6), np.full((size, rank), 1e-6), 1e-6
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for k in range(0, len(order), 128):
            own = order[k : k + 128]
            at, x, edge, n = _flat([rows[i] for i in own])
            vx = m.v[at] * x[:, None]
            total = np.add.reduceat(vx, edge)
            z = m.bias + np.add.reduceat(m.w[at] * x, edge) + 0.5 * (total**2 - np.add.reduceat(vx * vx, edge)).sum(axis=1)
            g = (sigmoid(z) - y[own]) * weight[own] / len(own)
            row = np.repeat(np.arange(len(own)), n)
            uniq, back = np.unique(at, return_inverse=True)
            dw = np.bincount(back, g[row] * x, len(uniq)) + l2 * m.w[uniq]
            part = (g[row] * x)[:, None] * (total[row] - vx)
            dv = np.stack([np.bincount(back, part[:, f], len(uniq)) for f in range(rank)], axis=1) + l2 * m.v[uniq]
            gw[uniq] += dw**2
            gv[uniq] += dv**2
            gb += g.sum() ** 2
            m.w[uniq] -= rate * dw / np.sqrt(gw[uniq])
            m.v[uniq] -= 0.5 * rate * dv / np.sqrt(gv[uniq])
            m.bias -= rate * g.sum() / np.sqrt(gb)
    return m


def train(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality", most: int = 3000, metadata: Sequence[str] = (), **kw) -> Machine:
    """Fits on at most `most` rows of each label. The ids come first, from the labels alone; the
    features are made where the texts are."""
    known = labels.filter(F.col(f"`{label}`").isNotNull() & F.col(f"`{id_col}`").isNotNull())
    known = known.groupBy(F.col(f"`{id_col}`").alias("_id")).agg(F.min(f"`{label}`").cast("int").alias("_y"))
    counts = {r["_y"]: r["count"] for r in known.groupBy("_y").count().collect()}
    picks = []
    for y in sorted(counts):
        picks.append(known.filter(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(most))
    if not picks:
        return fit([], np.zeros(0), np.zeros(0))
    chosen = picks[0]
    for more in picks[1:]:
        chosen = chosen.unionAll(more)
    ids = chosen.sparkSession.createDataFrame(chosen.collect(), "_id long, _y int")

    metadata = list(metadata)

    def make(x: pa.Array, *meta: pa.Array) -> pa.Array:
        found = [features(v, described(metadata, m)) for v, *m in zip(x.cast(pa.large_binary()).to_pylist(), *[c.to_pylist() for c in meta])]
        return pa.array([{"at": a.tolist(), "x": v.tolist()} for a, v in found], pa.struct([("at", pa.list_(pa.int32())), ("x", pa.list_(pa.float64()))]))

    extra = [f"_m{k}" for k in range(len(metadata))]
    texts = df.select(F.col(f"`{id_col}`").alias("_i"), F.col(f"`{text}`").alias("_t"), *[F.col(f"`{c}`").alias(m) for c, m in zip(metadata, extra)]).join(F.broadcast(ids), F.col("_i") == F.col("_id"))
    order = F.struct(F.xxhash64("_t"), "_t", *[F.col(m).cast("string") for m in extra])
    one = texts.groupBy("_id", "_y").agg(F.min_by(F.struct("_t", *extra), order).alias("r")).select("_id", "_y", "r.*")
    got = one.select("_id", "_y", F.arrow_udf(make, "at array<int>, x array<double>")("_t", *extra).alias("f")).toArrow()
    got = got.sort_by("_id")
    if not got.num_rows:
        return fit([], np.zeros(0), np.zeros(0))
    f = got["f"].combine_chunks()
    rows = [(a.values.to_numpy().astype(np.int64), x.values.to_numpy()) for a, x in zip(f.field("at"), f.field("x"))]
    y = got["_y"].to_numpy()
    seen = {k: max(1, int((y == k).sum())) for k in counts}
    weight = np.array([counts[k] / seen[k] for k in y.tolist()])
    return fit(rows, (y == 1).astype(float), weight * len(weight) / weight.sum(), **kw)


def score(text: Column | str, machine: Machine, metadata: Sequence[str] = ()) -> Column:
    """The score of a text column and the metadata columns that the machine was fitted with."""
    metadata = list(metadata)
    bias, w, v = machine.bias, machine.w.astype(np.float32), machine.v.astype(np.float32)

    def run(x: pa.Array, *meta: pa.Array) -> pa.Array:
        settle()
        m, out = Machine(bias, w, v), []
        held: list = []
        size = 0
        for b, *own in zip(x.cast(pa.large_binary()), *[c.to_pylist() for c in meta]):
            held.append(features(b.as_py(), described(metadata, own)))
            size += len(held[-1][0])
            if size > 100_000:
                out.append(sigmoid(m.raw(*_flat(held)[:3])))
                held, size = [], 0
        if held:
            out.append(sigmoid(m.raw(*_flat(held)[:3])))
        del held
        tidy()
        return pa.array(np.concatenate(out) if out else np.zeros(0), pa.float64())

    return F.arrow_udf(run, "double")(text, *[F.col(f"`{c}`") for c in metadata])


def held_out(doc_id: Column, fold: int = 2, folds: int = 4) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)) == fold


def classify(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", cut: float = 0.7, metadata: Sequence[str] = (), **kw) -> DataFrame:
    """(row, held_out, score, predicted) of each row of df; labels of held-out ids are not looked at.
    A null id is not held out. metadata: columns of df that are features too."""
    out = F.coalesce(held_out(F.col(f"`{id_col}`")), F.lit(False))
    machine = train(df, labels.filter(~out), id_col, text, metadata=metadata, **kw)
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), out.alias("held_out"), score(F.col(f"`{text}`"), machine, metadata).alias("score"))
    return rows.select("row", "held_out", "score", (F.col("score") >= cut).cast("int").alias("predicted"))
