"""Substring dedup by level-wise doubling of repeated word windows.

Words are maximal runs of bytes other than the six ASCII white-space characters. Windows of 10
words are looked at first, windows of 20 only where a window of 10 inside repeats, windows of 40 only
where two of 20 end to end repeat, and so on. The hash of a window is made of its halves' hashes.
repeated_spans() doubles until nothing repeats; dedup() stops at the first doubling, 20 words, as
longer windows remove no more.

At the first length a sample stands for all: of the 10-word windows in a 20-word window the one with
the least hash (by its upper half, the first of equals) is its anchor. Equal 20-word windows have equal anchors, so a window whose anchor
occurs once occurs once itself, and no repeat is missed. Anchors are a sixth of the words.

Anchors and windows first meet inside a block of a task. Of an anchor's places one is dealt by its hash, the
others are known to repeat and dealt anywhere; of a window's places only the least goes on, the others
have an earlier one. So a passage that very many documents share is a row a block, and no hot task. What
meets is sorted by the engine (which spills) and judged in one pass, so no group is held in memory.

Windows are told apart by two 64-bit hashes, of all their words and of their anchor. Two different windows
share both with a probability of 2 ** -128, or 2 ** -64 if they have the same anchor, so n windows, of
which at most m share an anchor, are confused with one of about n * m / 2 ** 65 at most.

Defined results: order is doc_id (null last), then position; rows with equal ids and texts are the same
place and do not remove each other; a null or empty text has no words; texts of under 20 words are
never changed; an empty table gives no rows. Other columns are carried unchanged.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.work import BROADCAST_IDS, settle, settled, stash, tidy

BASE = 10
#: Words whose hashes a worker remembers; anchors or windows of a block.
REMEMBER, BLOCK = 150_000, 400_000
#: Bytes of text whose windows are made together.
CHUNK = 1 << 20
#: In the two lowest bits of an anchor's place: its block has more places of the anchor; it is one of those.
MORE, KNOWN = 1, 2
_WHITE = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
_B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBER:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


_hashes = _Hashes()


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


def word_hashes(text: bytes) -> np.ndarray:
    words = text.split()
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def windows(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-word windows, by halves."""
    if n == 1:
        return h
    a = windows(h, n // 2)
    if n % 2:
        b = windows(h, n - n // 2)
        return _mix(a[: len(b)] * _B + np.roll(b, -(n // 2)) * _C)[: max(0, len(h) - n + 1)]
    k = max(0, len(h) - n + 1)
    return _mix(a[:k] * _B + a[n // 2 : n // 2 + k] * _C)


def least(x: np.ndarray, n: int) -> np.ndarray:
    """The minima of n neighbours, by doubling."""
    width = 1
    while width < n:
        step = min(width, n - width)
        x = np.minimum(x[:-step], x[step:])
        width += step
    return x


class Texts:
    """The words of consecutive rows end to end: `small`, hashes of the base windows, and `at`, the place of the
    anchor of each window of 2 * base words. `first` is each row's first word; a window is `whole` if its row
    has all its words."""

    def __init__(self, texts: list[bytes], base: int):
        words, count = [], []
        for text in texts:
            own = text.split()
            words += own
            count.append(len(own))
        self.hash = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
        self.row = np.repeat(np.arange(len(texts)), count)
        self.first = np.cumsum(count) - count
        self.small = windows(self.hash, base)
        n = max(0, len(words) - 2 * base + 1)
        self.whole = self.row[:n] == self.row[2 * base - 1 :]
        # The least upper half of a hash, then the first place: the words of a window alone decide which it is.
        key = (self.small & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(self.small), dtype=np.uint64)
        self.at = (least(key, base + 1)[:n] & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _chunks(batch, *columns: str):
    """Rows of a batch, about CHUNK bytes of text at a time: lists of _text as bytes and of the other columns."""
    lo, size, n = 0, 0, batch.num_rows
    for k, x in enumerate(batch["_text"]):
        size += len(x.as_buffer()) if x.is_valid else 0
        if size > CHUNK or k == n - 1:
            part = batch.slice(lo, k + 1 - lo)
            yield [x.as_buffer().to_pybytes() if x.is_valid else b"" for x in part["_text"]], *[part[c] for c in columns]
            lo, size = k + 1, 0


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _anchor_rows(held: list) -> pa.RecordBatch:
    h, at = np.concatenate([x[0] for x in held]), np.concatenate([x[2] for x in held])
    order = np.argsort(h, kind="stable")
    equal = h[order[1:]] == h[order[:-1]]
    at[order[1:][equal]] |= KNOWN
    at[order[:-1][equal]] |= MORE
    return pa.RecordBatch.from_arrays([_signed(h), pa.concat_arrays([x[1] for x in held]), pa.array(at)], ["h", "_id", "at"])


def _emit_anchors(base: int):
    """(h, _id, at) of each anchor: at is the row's mark, the position and the two bits."""

    def run(batches):
        settle()
        held, size = [], 0
        for batch in batches:
            for texts, ids, marks in _chunks(batch, "_id", "_m"):
                t = Texts(texts, base)
                own = np.unique(t.at[t.whole])
                row = t.row[own]
                held.append((t.small[own], ids.take(pa.array(row)), (marks.to_numpy().astype(np.int64)[row] << 32) + ((own - t.first[row]) << 2)))
                size += len(own)
                if size > BLOCK:
                    yield _anchor_rows(held)
                    held, size = [], 0
        if size:
            yield _anchor_rows(held)
        del held
        tidy(_hashes)

    return run


def _only_repeated(batches):
    """Of rows sorted by h those whose h occurs twice or more, here or in a block, as (_id, _m, at); one row is
    held over."""
    held = None  # (one-row batch, whether it has been found repeated)

    def out(b):
        at = b["at"].to_numpy()
        return pa.RecordBatch.from_arrays([b["_id"], pa.array((at >> 32).astype(np.int32)), pa.array(((at & 0xFFFFFFFF) >> 2).astype(np.int32))], ["_id", "_m", "at"])

    for batch in batches:
        if not batch.num_rows:
            continue
        h = batch["h"].to_numpy()
        joined = held is not None and held[0]["h"][0].as_py() == h[0]
        if held is not None and (held[1] or joined):
            yield out(held[0])
        near = batch["at"].to_numpy() & (MORE | KNOWN) != 0
        equal = h[1:] == h[:-1]
        near[1:] |= equal
        near[:-1] |= equal
        near[0] |= joined
        body = np.flatnonzero(near[:-1])
        if len(body):
            yield out(batch.take(pa.array(body)))
        held = (batch.slice(len(h) - 1, 1), bool(near[-1]))
    if held is not None and held[1]:
        yield out(held[0])


def _least_places(h: np.ndarray, w: np.ndarray, name: np.ndarray, none: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of windows (h, w) at places (none, name, at): those at the least place of their window, once, and
    those at a later one."""
    order = np.argsort(w, kind="stable")
    equal = w[order[1:]] == w[order[:-1]]
    many = np.concatenate([equal, [False]]) | np.concatenate([[False], equal])
    alone, some = order[~many], order[many]
    some = some[np.lexsort((at[some], name[some], none[some], h[some], w[some]))]
    new = np.ones(len(some), bool)
    new[1:] = (w[some][1:] != w[some][:-1]) | (h[some][1:] != h[some][:-1])
    first = some[np.maximum.accumulate(np.where(new, np.arange(len(some)), 0))] if len(some) else some
    later = (name[some] != name[first]) | (none[some] != none[first]) | (at[some] != at[first])
    return np.sort(np.concatenate([alone, some[new]])), some[later]


def _packed(ids: pa.Array, name: np.ndarray, none: np.ndarray, at: np.ndarray, own: np.ndarray) -> tuple[pa.Array, np.ndarray, list[bytes]]:
    """The places `own` by document: ids, marks and packed positions."""
    own = own[np.lexsort((at[own], name[own], none[own]))]
    mark, pos = at[own] >> 32, (at[own] & 0xFFFFFFFF).astype(np.int32)
    edge = np.flatnonzero(np.concatenate([[True], (np.diff(name[own]) != 0) | (np.diff(mark) != 0) | (np.diff(none[own].astype(int)) != 0)]))
    ends = [*edge[1:].tolist(), len(own)]
    return ids.take(pa.array(own[edge])), mark[edge], [pos[a:z].tobytes() for a, z in zip(edge.tolist(), ends)]


_WINDOWS = "h long, w long, _id long, at long, starts binary"


def _emit_windows(base: int, all_places: bool):
    """(h, w, _id, at, null) of the windows whose anchors repeat; at is the row's mark and the position. Unless
    all places are wanted, only those at the least place of their block; the others, which have an earlier
    one, as (null, null, _id, mark, packed positions)."""

    def rows(held: list):
        ids = pa.concat_arrays([x[0] for x in held])
        h, w, at = (np.concatenate([x[k] for x in held]).view(np.int64) for k in (1, 2, 3))
        name, none = ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)
        own, later = (np.arange(len(h)), np.zeros(0, np.int64)) if all_places else _least_places(h, w, name, none, at)
        for k in range(0, len(own), 50_000):
            part = own[k : k + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(h[part]), pa.array(w[part]), ids.take(pa.array(part)), pa.array(at[part]), pa.nulls(len(part), pa.binary())], ["h", "w", "_id", "at", "starts"])
        if len(later):
            doc, mark, starts = _packed(ids, name, none, at, later)
            yield pa.RecordBatch.from_arrays([pa.nulls(len(doc), pa.int64()), pa.nulls(len(doc), pa.int64()), doc, pa.array(mark << 32), pa.array(starts, pa.binary())], ["h", "w", "_id", "at", "starts"])

    def run(batches):
        settle()
        held, size = [], 0
        for batch in batches:
            for texts, ids, marks, hits in _chunks(batch, "_id", "_m", "hits"):
                t = Texts(texts, base)
                hit = np.zeros(len(t.small) + 1, bool)
                hit[np.repeat(t.first, hits.value_lengths().to_numpy()) + hits.flatten().to_numpy()] = True
                own = np.flatnonzero(t.whole & hit[t.at])
                row = t.row[own]
                held.append((ids.take(pa.array(row)), t.small[t.at[own]], windows(t.hash, 2 * base)[own], (marks.to_numpy().astype(np.int64)[row] << 32) + own - t.first[row]))
                size += len(own)
                if size > BLOCK:
                    yield from rows(held)
                    held, size = [], 0
        if size:
            yield from rows(held)
        del held
        tidy(_hashes)

    return run


def _later(batches):
    """Of windows sorted by (w, h, place) all but those at the first place, packed by document; what is packed
    already passes."""
    last = None  # (h, w, id, at) of the first place of the run that goes on
    for batch in batches:
        done = batch["starts"].is_valid()
        if done.true_count:
            ready = batch.filter(done)
            yield pa.RecordBatch.from_arrays([ready["_id"], pa.array((ready["at"].to_numpy() >> 32).astype(np.int32)), ready["starts"]], ["_id", "_m", "starts"])
            batch = batch.filter(pa.compute.invert(done))
        if not batch.num_rows:
            continue
        h, w, at = (batch[c].to_numpy() for c in ("h", "w", "at"))
        none = batch["_id"].is_null().to_numpy(zero_copy_only=False)
        name = batch["_id"].fill_null(0).to_numpy()
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (w[1:] != w[:-1])
        first = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
        same = (name == name[first]) & (at == at[first]) & (none == none[first])
        if last is not None and (h[0], w[0]) == last[:2]:
            head = first == 0
            same[head] = ((name == last[2]) & (at == last[3]) & (none == last[4]))[head]
            keep = last
        else:
            keep = None
        f = first[-1]
        last = keep if keep and f == 0 else (h[f], w[f], name[f], at[f], none[f])
        gone = np.flatnonzero(~same)
        if not len(gone):
            continue
        doc, mark, starts = _packed(batch["_id"], name, none, at, gone)
        yield pa.RecordBatch.from_arrays([doc, pa.array(mark.astype(np.int32)), pa.array(starts, pa.binary())], ["_id", "_m", "starts"])


def repeated_windows(df: DataFrame, id_col: str = "doc_id", text: str = "text", base: int = BASE) -> DataFrame:
    """(_id, _m, starts) of every document with a window of 2 * base words that also starts earlier:
    starts is a list of packed 32-bit positions of such windows; _m tells rows of one id apart."""

    def build():
        found = _candidates(df, id_col, text, base, all_places=False)
        dealt = found.repartition(F.when(F.col("starts").isNull(), F.col("w")).otherwise(F.xxhash64("_id", "at")))
        ordered = dealt.sortWithinPartitions("w", "h", F.col("_id").asc_nulls_last(), "at")
        gone = ordered.mapInArrow(_later, "_id long, _m int, starts binary")
        return gone.groupBy("_id", "_m").agg(F.collect_list("starts").alias("starts"))

    return settled(build, df.sparkSession, "repeats")


def _repeating(rows: DataFrame) -> DataFrame:
    """Of places (h, w, _id, at) those whose window (h, w) is at two or more."""
    often = rows.groupBy("h", "w").agg(F.count("*").alias("_n")).filter("_n > 1").select("h", "w")
    return rows.join(often, ["h", "w"], "left_semi")


def repeated_spans(df: DataFrame, id_col: str = "doc_id", text: str = "text", base: int = BASE) -> DataFrame:
    """(_id, _m, at, width): of each place (word number at, from 0) where a window of 2 * base words begins
    that is at two or more places, the greatest width of 2 * base, 4 * base, ... whose window there is so.
    Levels are doubled until no window repeats."""
    return settled(lambda: _spans(df, id_col, text, base), df.sparkSession, "spans")


def _spans(df: DataFrame, id_col: str, text: str, base: int) -> DataFrame:
    width = 2 * base
    level = stash(_repeating(_candidates(df, id_col, text, base, all_places=True).drop("starts").dropDuplicates()), "level")
    levels = []
    while not level.isEmpty():
        levels.append(level.select("_id", "at", F.lit(width).cast("long").alias("width")))
        ahead = level.select(F.col("h").alias("h2"), F.col("w").alias("w2"), F.col("_id").alias("_id2"), (F.col("at") - width).alias("at2"))
        both = level.join(ahead, F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("at") == F.col("at2")))
        halves = ["h", "w", "h2", "w2"]
        level = stash(_repeating(both.select(F.xxhash64(*halves).alias("h"), F.xxhash64(F.lit(1), *halves).alias("w"), "_id", "at")), "level")
        width *= 2
    if not levels:
        return level.select("_id", F.lit(0).alias("_m"), "at", F.lit(0).cast("long").alias("width"))
    found = reduce(DataFrame.unionAll, levels).groupBy("_id", "at").agg(F.max("width").alias("width"))
    return found.select("_id", F.shiftright("at", 32).cast("int").alias("_m"), F.col("at").bitwiseAND(F.lit(0xFFFFFFFF)).alias("at"), "width")


def _candidates(df: DataFrame, id_col: str, text: str, base: int, all_places: bool) -> DataFrame:
    """What _emit_windows() says of the windows of 2 * base words whose anchors repeat."""
    rows = _keyed(df, id_col, text)
    found = rows.mapInArrow(_emit_anchors(base), "h long, _id long, at long")
    dealt = found.repartition(F.when(F.col("at").bitwiseAND(F.lit(KNOWN)) > 0, F.xxhash64("h", "_id", "at")).otherwise(F.col("h"))).sortWithinPartitions("h")
    hits = dealt.mapInArrow(_only_repeated, "_id long, _m int, at int").groupBy("_id", "_m").agg(F.collect_list("at").alias("hits"))
    hits = stash(hits, "anchors")
    both = _same(_narrow(rows, hits), hits, "inner")
    return both.mapInArrow(_emit_windows(base, all_places), _WINDOWS)


def _keyed(df: DataFrame, id_col: str, text: str) -> DataFrame:
    t = F.col(f"`{text}`")
    return df.select(F.col(f"`{id_col}`").cast("long").alias("_id"), (F.hash(t).bitwiseAND(F.lit(0x7FFFFFFF))).alias("_m"), t.alias("_text"))


def _same(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    r = right.withColumnRenamed("_id", "_id2").withColumnRenamed("_m", "_m2")
    return left.join(r, F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_m") == F.col("_m2")), how)


def _narrow(rows: DataFrame, marked: DataFrame) -> DataFrame:
    """The rows that `marked` names, without a shuffle where its ids are few enough to broadcast."""
    ids = marked.select("_id", "_m")
    return _same(rows, F.broadcast(ids), "left_semi") if ids.count() <= BROADCAST_IDS else rows


def covered(starts: list[bytes] | None, n: int, width: int) -> np.ndarray:
    """Which of n words lie in a window that starts at one of the packed positions."""
    edge = np.zeros(n + width + 1, np.int64)
    for b in starts or ():
        at = np.frombuffer(b, np.int32)
        np.add.at(edge, at, 1)
        np.add.at(edge, at + width, -1)
    return np.cumsum(edge)[:n] > 0


def dedup(df: DataFrame, id_col: str = "doc_id", text: str = "text", base: int = BASE) -> DataFrame:
    """(row, n_words, n_removed, kept_sha256, kept_text) of each row of df. kept_text is the text
    without the removed words and the white space behind them; kept_sha256 is of the kept words joined
    by one space."""
    at = df.columns.index(text)
    rows = df.select(*[F.col(f"`{c}`").alias(f"_c{k}") for k, c in enumerate(df.columns)])
    t = F.col(f"_c{at}")
    rows = rows.withColumns({"_id": F.col(f"_c{df.columns.index(id_col)}").cast("long"), "_m": F.hash(t).bitwiseAND(F.lit(0x7FFFFFFF))})
    gone = repeated_windows(df, id_col, text, base)
    width = 2 * base
    if gone.count() <= BROADCAST_IDS:
        ids = F.broadcast(gone.select("_id", "_m"))
        changed = _same(_same(rows, ids, "left_semi"), gone, "left")
        both = changed.unionByName(_same(rows, ids, "left_anti"), allowMissingColumns=True)
    else:
        both = _same(rows, gone, "left")
    kind = pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept_text", pa.string())])

    def keep(texts: pa.Array, starts: pa.Array) -> pa.Array:
        settle()
        found = []
        for x, s in zip(texts, starts):
            b = x.as_buffer().to_pybytes() if x.is_valid else b""
            words = b.split()
            if not s.is_valid:
                found.append({"n_words": len(words), "n_removed": 0, "kept_sha256": hashlib.sha256(b" ".join(words)).hexdigest(), "kept_text": None})
                continue
            gone = covered(s.as_py(), len(words), width)
            space = _WHITE[np.frombuffer(b, np.uint8)]
            at = np.append(np.flatnonzero(~space & np.concatenate([[True], space[:-1]])), len(b))
            edge = np.flatnonzero(np.diff(gone, prepend=True, append=True)).tolist()  # where runs of kept words begin and end
            runs = list(zip(edge[::2], edge[1::2]))
            sha = hashlib.sha256(b" ".join([w for a, z in runs for w in words[a:z]])).hexdigest()
            kept = b[: at[0]] + b"".join([b[at[a] : at[z]] for a, z in runs])
            found.append({"n_words": len(words), "n_removed": int(gone.sum()), "kept_sha256": sha, "kept_text": kept.decode("utf-8", "replace")})
        out = pa.array(found, kind)
        del found
        tidy()
        return out

    done = both.withColumn("k", F.arrow_udf(keep, "n_words long, n_removed long, kept_sha256 string, kept_text string")(t, "starts"))
    row = F.struct(*[F.col(f"_c{k}").alias(c) for k, c in enumerate(df.columns)]).alias("row")
    return done.select(row, "k.n_words", "k.n_removed", "k.kept_sha256", F.when(F.col("k.n_removed") > 0, F.col("k.kept_text")).otherwise(t).alias("kept_text"))
