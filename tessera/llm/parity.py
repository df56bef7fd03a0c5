"""N-gram Jaccard join by parity sketches.

A document's set is its distinct word shingles, hashed to 64 bits. Its sketch in a size band has k
parts; a shingle belongs to one part and is XORed into it, so parts that differ number at most the
sets' symmetric difference, which a similarity of s bounds by d for the band. With k = d + 1 + m parts
at least m + 1 agree. A part without shingles says little and is not joined on: a set with up to m
such parts still meets every partner in another part, and a set with more is sketched again with the
next hash, until it has no more than m. Both partners do so by rules of their own set, so none is
missed. Equal sets are one class and travel once a task.

Candidates of a part: the groups of sets that share its key. A group's members are first compared with
one pivot, the member with the most keys that others share, as in a family of copies it is the nearest
to all. Verified pairs give components. The sets of groups that still span several components, if they have as
many keys in such groups as a link needs, meet once more, by those of their rarest shingles that two linked sets must share (n - ceil(s * n) + 1 of the larger
set, n - ceil(2 * s * n / (1 + s)) + 1 of the smaller), and only where sizes and the places of the common
shingle leave room for a link. So members of a family that differ too much are left out without being
compared with each other. Pairs are bounded by the Hamming distance of 1024-bit parity sketches, then
verified on the sets.

A key that very many sets share is no hot task: of a block's members one is dealt by the key, the others
anywhere.

Defined results: a null or empty text, or one without words, has an empty set and links to nothing; a
text with fewer words than a shingle is one shingle of all of them; documents with equal sets are
linked; a null doc_id can be linked and counts last; repeated rows belong to one class; an empty table
gives no rows. Other columns do not matter to join(); keep_one() carries them.

Classes are named by 62-bit hashes of their sets: two different sets of a corpus of n share one with a
probability of n * n / 2 ** 63.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.components import components
from tessera.llm.substring import _hashes as word_memo
from tessera.llm.substring import _mix, word_hashes
from tessera.llm.work import discard, settle, settled, sized, stash, tidy

#: Ratio of the sizes in a band; bits of a sketch; keys of a task's block.
RATIO, BITS, BLOCK = 1.4, 1024, 250_000
#: Most sketches that are broadcast (BITS / 8 bytes each).
SKETCHES = 100_000
#: Classes that a task remembers; ratio of the sizes in a bucket of the finer groups, and pivots of their first round.
REMEMBER, STEP, PIVOTS = 200_000, 1.03, 8
MORE, KNOWN = 1, 2
_K = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: bytes | None, n: int) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles of a text, A-Z in lower case."""
    h = word_hashes((text or b"").lower())
    if not len(h):
        return h
    width = min(n, len(h))
    out = np.full(len(h) - width + 1, width, np.uint64)
    for k in range(width):
        out = _mix(out * _K + h[k : len(h) - width + 1 + k])
    return np.unique(out)


def class_of(s: np.ndarray) -> int:
    """A signed 64-bit name of a set, its two lowest bits 0."""
    with np.errstate(over="ignore"):
        a, b = s.sum(dtype=np.uint64), np.bitwise_xor.reduce(_mix(s * _K))
        x = _mix(np.array([a * _K + b + np.uint64(len(s))], np.uint64))
    return int(x.view(np.int64)[0]) & ~(KNOWN | MORE)


@functools.lru_cache(8)
def bands(percent: int, ratio: float = RATIO) -> np.ndarray:
    """Least sizes of the bands; a band is no narrower than the sizes that can link."""
    lows = [1]
    while lows[-1] < 1 << 40:
        lo = lows[-1]
        lows.append(max(lo + 1, math.ceil(lo * ratio), lo * 100 // percent + 1))
    return np.array(lows, np.int64)


@functools.lru_cache(1 << 12)
def layout(lo: int, hi: int, percent: int) -> tuple[int, int]:
    """(parts k, spare parts m) for sets of lo to hi shingles; k = 0: only equal sets can link. m covers
    the empty parts that a set of lo shingles has but for chance, as far as parts stay large."""
    d = 2 * hi * (100 - percent) // (100 + percent)
    if not d:
        return 0, 0
    tried = []
    for m in range(2, d + 3):
        k = d + 1 + m
        q = math.exp(-lo / k)
        tried.append((k * q + 1.3 * math.sqrt(k * q * (1 - q)) - m, m))
        if tried[-1][0] <= 0:
            return k, m
    over, m = min(tried)
    if over > 2:
        raise ValueError(f"{percent} percent is too little similarity for parity sketches")
    return d + 1 + m, m


def keys(s: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """The join keys of a set, its non-empty parts in its band and in the next if it can link there; and how
    many of them it shares at least with any set that it links with: of the spare + 1 parts without a
    difference those that are not empty."""
    n, out, lows, need = len(s), [], bands(percent), 1 << 30
    band = int(np.searchsorted(lows, n, "right")) - 1
    for b in (band, band + 1):
        if b > band and n * 100 < int(lows[b]) * percent:
            break
        parts, spare = layout(int(lows[b]) * percent // 100, int(lows[b + 1]) - 1, percent)
        level = 0
        while parts:
            x = _mix(s * _K + np.uint64(level))
            part = ((x >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            edge = np.flatnonzero(np.diff(part[order], prepend=-1))
            word = np.bitwise_xor.reduceat(s[order], edge)
            tag = np.uint64((b * 1000 + level) << 32) + part[order][edge].astype(np.uint64)
            out.append(_mix(_mix(tag * _K + np.uint64(1)) ^ word))
            if parts - len(edge) <= spare:
                need = min(need, 1 if level else spare + 1 - (parts - len(edge)))
                break
            level += 1
    return (np.concatenate(out), need) if out else (np.zeros(0, np.uint64), 1)


def sketch(s: np.ndarray) -> np.ndarray:
    """Parity bits: each shingle flips one of BITS."""
    return np.packbits((np.bincount((s >> np.uint64(7)).astype(np.int64) % BITS, minlength=BITS) & 1).astype(np.uint8))


def _texts(batch):
    return [x.as_buffer().to_pybytes() if x.is_valid else None for x in batch["text"]]


def _describe(n: int):
    def run(x: pa.Array) -> pa.Array:
        out = []
        for v in x:
            s = shingles(v.as_buffer().to_pybytes() if v.is_valid else None, n)
            out.append(class_of(s) if len(s) else None)
        tidy()
        return pa.array(out, pa.int64())

    return F.arrow_udf(run, "long")


def _described(df: DataFrame, n: int, percent: int) -> DataFrame:
    """(doc_id, c, n, keys, need) of each row: its class, the size of its set, and once for equal sets that a
    task meets the packed join keys of the set and how many of them a link needs."""

    def run(batches):
        settle()
        seen: set = set()
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                part = batch.slice(lo, 2048)
                rows = []
                for text in _texts(part):
                    s = shingles(text, n)
                    c, k, need = class_of(s) if len(s) else None, None, None
                    if len(s) and c not in seen:
                        if len(seen) > REMEMBER:
                            seen.clear()
                        seen.add(c)
                        k, need = keys(s, percent)
                        k = k.tobytes()
                    rows.append((c, len(s), k, need))
                yield pa.RecordBatch.from_arrays([part["doc_id"], *[pa.array(x, kind) for x, kind in zip(zip(*rows), (pa.int64(), pa.int64(), pa.binary(), pa.int32()))]], ["doc_id", "c", "n", "keys", "need"])
        del seen
        tidy(word_memo)

    return df.select("doc_id", "text").mapInArrow(run, "doc_id long, c long, n long, keys binary, need int")


def _dealt(k: np.ndarray, c: np.ndarray) -> pa.RecordBatch:
    """Rows (k, c) of a block. In the two lowest bits of c, which classes leave free: MORE, the block has other
    members of the key; KNOWN, it is such a member, and need not meet the others to be known in company."""
    order = np.argsort(k, kind="stable")
    equal = k[order[1:]] == k[order[:-1]]
    c[order[1:][equal]] |= KNOWN
    c[order[:-1][equal]] |= MORE
    return pa.RecordBatch.from_arrays([pa.array(k), pa.array(c)], ["k", "c"])


def _signatures(described: DataFrame) -> DataFrame:
    """(k, c) of every key, in blocks."""

    def run(batches):
        ks, cs, size = [], [], 0
        for batch in batches:
            for c, packed in zip(batch["c"].to_pylist(), batch["keys"]):
                k = np.frombuffer(packed.as_buffer(), np.int64)
                ks.append(k)
                cs.append(np.full(len(k), c, np.int64))
                size += len(k)
                if size > BLOCK:
                    yield _dealt(np.concatenate(ks), np.concatenate(cs))
                    ks, cs, size = [], [], 0
        if size:
            yield _dealt(np.concatenate(ks), np.concatenate(cs))

    return described.select("c", "keys").filter("keys IS NOT NULL").mapInArrow(run, "k long, c long")


def _shared(batches):
    """Of rows sorted by k the (k, c) that are in company: those known to be, and those whose key others
    share or whose block has more."""
    held = None  # the one row of the last key that has not been given out: (k, c)
    now = None  # (key, whether it is in company)
    for batch in batches:
        if not batch.num_rows:
            continue
        k, c = batch["k"].to_numpy(), batch["c"].to_numpy()
        alone, c = c & (KNOWN | MORE) == 0, c & ~np.int64(KNOWN | MORE)
        new = np.concatenate([[True], k[1:] != k[:-1]])
        run = np.cumsum(new) - 1
        low, high = (np.full(run[-1] + 1, x, np.int64) for x in ((1 << 63) - 1, -(1 << 63)))
        np.minimum.at(low, run, c)
        np.maximum.at(high, run, c)
        company = low != high
        np.logical_or.at(company, run, ~alone)
        extra = []
        if now is not None and now[0] == k[0]:
            company[0] |= now[1] or (held is not None and (held[1] != low[0] or held[1] != high[0]))
            if held is not None and company[0]:
                extra.append(held)
                held = None
        else:
            held = None
        now = (k[-1], bool(company[-1]))
        out = company[run]
        held = None if company[-1] else (k[-1], c[-1])
        if out.any() or extra:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[x] for x, _ in extra] + [k[out]]).astype(np.int64)), pa.array(np.concatenate([[x] for _, x in extra] + [c[out]]).astype(np.int64))], ["k", "c"])


def _sets(df: DataFrame, n: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                sets = [s for s in (shingles(t, n) for t in _texts(batch.slice(lo, 256))) if len(s)]
                if sets:
                    yield pa.RecordBatch.from_arrays([
                        pa.array([class_of(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([sketch(s).tobytes() for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary()),
                    ], ["c", "n", "sketch", "s"])
        tidy(word_memo)

    return df.select("text").mapInArrow(run, "c long, n long, sketch binary, s binary")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link: bounded by sizes and sketches, then counted on the sets."""
    def near(na: pa.Array, nb: pa.Array, sa: pa.Array, sb: pa.Array) -> pa.Array:
        if not len(na):
            return pa.array([], pa.bool_())
        x, y = (np.frombuffer(b"".join(s.to_pylist()), np.uint8).reshape(-1, BITS // 8) for s in (sa, sb))
        bits = np.unpackbits(x ^ y, axis=1).sum(axis=1, dtype=np.int64)
        n = na.to_numpy() + nb.to_numpy()
        most = n - 2 * -(-percent * n // (100 + percent))  # of the symmetric difference
        return pa.array(bits <= most)

    def linked(na: pa.Array, nb: pa.Array, sa: pa.Array, sb: pa.Array) -> pa.Array:
        out = []
        for a, b in zip(sa, sb):
            x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (a, b))
            common = len(np.intersect1d(x, y, assume_unique=True))
            out.append(100 * common >= percent * (len(x) + len(y) - common))
        return pa.array(out, pa.bool_())

    side = lambda frame, x, *c: frame.select(F.col("c").alias(x), *[F.col(y).alias(f"{y}_{x}") for y in c])
    small = sets.count() <= SKETCHES
    thin = lambda x: F.broadcast(side(sets, x, "n", "sketch")) if small else side(sets, x, "n", "sketch")
    light = pairs.join(thin("a"), "a").join(thin("b"), "b")
    light = light.filter((100 * F.col("n_a") >= percent * F.col("n_b")) & (100 * F.col("n_b") >= percent * F.col("n_a")))
    close = stash(light.filter(F.arrow_udf(near, "boolean")("n_a", "n_b", "sketch_a", "sketch_b")).select("a", "b"), "close")
    used = stash(close.select("a").unionAll(close.select("b")).distinct().withColumnRenamed("a", "c"), "used")
    few = sets.join(sized(used), "c", "left_semi")
    full = side(few, "b", "n", "s").join(sized(close), "b").join(side(few, "a", "n", "s"), "a")
    return full.filter(F.arrow_udf(linked, "boolean")("n_a", "n_b", "s_a", "s_b")).select("a", "b")


def _grouped(described: DataFrame) -> DataFrame:
    """(k, c) of the keys that classes share."""
    deal = F.when(F.col("c").bitwiseAND(F.lit(KNOWN)) > 0, F.xxhash64("k", "c")).otherwise(F.col("k"))
    return _signatures(described).repartition(deal).sortWithinPartitions("k").mapInArrow(_shared, "k long, c long")


def links(df: DataFrame, members: DataFrame, groups: DataFrame, n: int, percent: int) -> DataFrame:
    """(node, label) of the linked classes. df has doc_id and text; members (doc_id, c, n, need) are its classes,
    groups the (k, c) of keys that classes share."""
    shared = stash(groups.groupBy("c").agg(F.count("*").alias("shared")), "candidates")
    some = shared.select("c")
    ids = stash(members.join(sized(some), "c", "left_semi").groupBy("c").agg(F.min("doc_id").alias("_d")).select("_d").distinct(), "ids")
    texts = df.join(sized(ids), F.col("doc_id").eqNullSafe(F.col("_d")), "left_semi")
    sets = stash(_sets(texts, n).join(sized(some), "c", "left_semi"), "sets")
    if sets.count() != shared.count():  # ids that name several rows bring a set more than once
        sets = stash(sets.dropDuplicates(["c"]), "sets")
    ranked = groups.join(sized(shared), "c")
    pivot = stash(ranked.groupBy("k").agg(F.max(F.struct("shared", "c")).getField("c").alias("p")), "pivots")
    stars = groups.join(sized(pivot), "k").filter("c <> p").select(F.least("c", "p").alias("a"), F.greatest("c", "p").alias("b")).distinct()
    known = stash(_verified(stash(stars, "pairs"), sets, percent), "links")
    labels = stash(components(known), "labels")
    named = stash(_labelled(groups, labels), "named")
    mixed = named.groupBy("k").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count("*").alias("many")).filter("x <> y AND many > 2")
    crowded = stash(named.join(sized(stash(mixed.select("k"), "keys")), "k", "left_semi").groupBy("c").agg(F.count("*").alias("have")), "crowded")
    need = members.filter("need IS NOT NULL").select("c", "need").join(sized(crowded), "c").groupBy("c").agg(F.min("need").alias("need"), F.min("have").alias("have"))
    open_ = stash(need.filter("have >= need").select("c"), "open")
    if open_.isEmpty():
        return labels
    fine = stash(_fine(sets.join(sized(open_), "c", "left_semi"), percent), "fine")
    lo, hi, last = 0, PIVOTS, 1
    while last and lo < last:
        fine = stash(_mixed(_labelled(fine, labels)), "mixed")
        last = fine.agg(F.max("many")).first()[0]
        more = stash(_pivots(fine, lo, hi, percent), "pairs")
        if not more.isEmpty():
            known = known.unionAll(stash(_verified(more, sets, percent), "links"))
            labels = stash(components(known), "labels")
        fine, lo, hi = fine.drop("label", "many"), hi, hi * 8
    return labels


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    return rows.join(sized(labels.withColumnRenamed("node", "c")), "c", "left").withColumn("label", F.coalesce("label", "c"))


def _fine(sets: DataFrame, percent: int) -> DataFrame:
    """(t, b, c, n, at, own): where sets meet by shingle t and size bucket b. A set's shingles are ordered
    from the rarest; own: shingle `at` is among those that it must share as the smaller set, and b is the
    bucket of its size; else as the larger, and b one of the buckets of the smaller sets that can link."""

    def explode(batches):
        for batch in batches:
            for c, n, s in zip(batch["c"].to_pylist(), batch["n"].to_pylist(), batch["s"]):
                t = np.frombuffer(s.as_buffer(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(t), pa.array(np.full(n, c)), pa.array(np.full(n, n))], ["t", "c", "n"])

    tokens = sets.select("c", "n", "s").mapInArrow(explode, "t long, c long, n long")
    often = tokens.groupBy("t").agg(F.count("*").alias("f")).filter("f > 1")
    one = Window.partitionBy("c")
    at = F.col("n") - F.count("*").over(one) + F.row_number().over(one.orderBy("f", "t")) - 1
    rows = tokens.join(often, "t").withColumn("at", at).filter(f"at <= n - ceil({percent} * n / 100)")
    bucket = lambda x: F.floor(F.log(x.cast("double")) / math.log(STEP)).cast("int")
    n = F.col("n")
    own = F.expr(f"at <= n - ceil(2 * {percent} * n / {100 + percent})")
    low = F.expr(f"CAST(ceil({percent} * n / 100) AS LONG)")
    high = F.expr(f"least(n, CAST(floor((n - at) * {100 + percent} / {percent}) AS LONG) - n)")
    to = F.when(high >= low, F.sequence(bucket(low), bucket(high))).otherwise(F.array().cast("array<int>"))
    rows = rows.withColumn("own", own).withColumn("to", F.array_distinct(F.concat(F.when(own, F.array(bucket(n))).otherwise(F.array().cast("array<int>")), to)))
    return rows.select("t", F.explode("to").alias("b"), "c", "n", "at", "own", bucket(n).alias("_b")).select("t", "b", "c", "n", "at", (F.col("own") & (F.col("b") == F.col("_b"))).alias("own"))


def _mixed(rows: DataFrame) -> DataFrame:
    """The members of the finer groups in which sets can meet that are not in one component, with the number of members."""
    groups = rows.groupBy("t", "b").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.bool_or("own").alias("any"), F.count("*").alias("many"))
    open_ = stash(groups.filter("x <> y AND any").select("t", "b", "many"), "keys")
    return rows.join(sized(open_), ["t", "b"])


def _pivots(rows: DataFrame, lo: int, hi: int, percent: int) -> DataFrame:
    """Pairs of pivots with members of their group in other components that leave room for a link. A group's
    sets are in the order of a hash; each is a pivot in the round in which about lo to hi - 1 stand before it."""
    named = rows.withColumn("u", F.pmod(F.xxhash64("c"), F.lit(1 << 30)) / F.lit(float(1 << 30)))
    p = named.filter(f"own AND u * many >= {lo} AND u * many < {hi}").select("t", "b", *[F.col(x).alias(f"{x}_p") for x in ("c", "n", "at", "u", "label")])
    near = f"label <> label_p AND (NOT own OR u > u_p) AND least(n - at, n_p - at_p) * {100 + percent} >= {percent} * (n + n_p) AND 100 * n >= {percent} * n_p AND 100 * n_p >= {percent} * n"
    both = named.join(p, ["t", "b"]).filter(near)
    return both.select(F.least("c", "c_p").alias("a"), F.greatest("c", "c_p").alias("b")).distinct()


def _joined(df: DataFrame, id_col: str, text: str, n: int, percent: int) -> DataFrame:
    docs = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    described = stash(_described(docs, n, percent), "described")
    members, groups = stash(described.drop("keys"), "members"), stash(_grouped(described), "groups")
    discard(described)  # the keys are as large as the texts
    labels = links(docs, members, groups, n, percent)
    named = members.drop("need").join(sized(labels.withColumnRenamed("node", "c")), "c", "left").withColumn("root", F.coalesce("label", "c"))
    least = named.filter("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("least"), F.count("*").alias("many")).filter("many > 1")
    out = named.join(sized(stash(least.select("root", "least"), "least")), "root", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"), "c", "root")


def join(df: DataFrame, id_col: str = "doc_id", text: str = "text", n: int = 4, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row: the least doc_id reachable by links of
    similarity percent / 100."""
    return settled(lambda: _joined(df, id_col, text, n, percent).drop("c", "root"), df.sparkSession, "components")


def keep_one(df: DataFrame, id_col: str = "doc_id", text: str = "text", n: int = 5, percent: int = 80) -> DataFrame:
    """The rows of df, one of each component: one with the least doc_id. Columns unchanged; rows with an
    empty set all stay."""
    found = settled(lambda: _joined(df, id_col, text, n, percent), df.sparkSession, "components")
    row = F.struct(*[F.col(f"`{x}`") for x in df.columns]).alias("row")
    rows = df.select(row, F.col(f"`{id_col}`").cast("long").alias("_i"), F.col(f"`{text}`").alias("_t"))
    odd = found.groupBy("doc_id").count().filter("count > 1 OR doc_id IS NULL").limit(1).collect()
    if not odd:
        gone = stash(found.filter("doc_id <> component_id").select(F.col("doc_id").alias("_gone")), "dropped")
        return rows.drop("_t").join(sized(gone), F.col("_i") == F.col("_gone"), "left_anti").select("row.*")
    # Ids that are null or repeated do not name rows: number the rows of each component.
    roots = stash(found.filter("c IS NOT NULL").select(F.col("c").alias("_k"), "root").distinct(), "roots")
    named = rows.select("row", "_i", _describe(n)("_t").alias("_c")).join(roots, F.col("_c") == F.col("_k"), "left")
    first = F.row_number().over(Window.partitionBy("root").orderBy(F.col("_i").asc_nulls_last()))
    return named.withColumn("_nth", first).filter("root IS NULL OR _nth = 1").select("row.*")
