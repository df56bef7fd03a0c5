"""Spelling variants: words one edit apart, found by bands of letter parities.

A word's mask has a bit for each letter (rare letters share bits), set where the letter occurs an odd number of
times. One inserted or deleted letter flips one bit, a replaced one two at most, so of three bands of the mask
one at least is equal in two near words. Words meet by band, bits and length: a word stands under its own length
and under the next, as near words differ by one letter at most. In a group, pairs of masks at most two bits apart
are verified letter by letter; a pair is reported from the first band in which it is equal, so none comes twice.

A band's group with more than CROWD words is split further, by the first or the last half of the word: one edit
leaves one of the two halves as it is. What is crowded still, as under a very common ending, is dealt into blocks
that meet two at a time. So a task holds no more than two blocks, and nothing is dropped.

Defined results: a null or empty text has no words; a null id is hashed as the word null; repeated rows count
each; a run of letters of any length is one word; words that tie in number are taken in code-point order; an empty
table gives no rows. Other columns do not matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.work import settle, settled, sized, stash, tidy

LETTERS = "[A-Za-zÀ-ÿ]+"
#: Bits of a band, and the bands.
WIDE, BANDS = 21, 3
#: Most words of a group, or of a block of a larger one.
CROWD = 2048
#: Letters from frequent to rare: dealt to the bands in turn, so that the bands part words about equally well.
BY_USE = "etaoinsrhldcumfpgwybvkxjqz"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(df: DataFrame, id_col: str = "doc_id", text: str = "text", least: int = 6, often: int = 5, slip: int | None = None) -> DataFrame:
    """(word, n): runs of letters with A-Z lower-cased, at least `least` code points long and `often` times there.

    `slip` plants misspellings: where it divides the crc32 of `id:run`, the run loses the code point at crc32 modulo
    its length."""
    runs = F.explode(F.regexp_extract_all(F.col(f"`{text}`"), F.lit(LETTERS), 0)).alias("run")
    rows = df.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("null")).alias("id"), runs).filter(F.length("run") >= least)
    rows = rows.select("id", F.translate("run", _UPPER, _LOWER).alias("word"))
    if slip:
        h = F.crc32(F.concat("id", F.lit(":"), "word").cast("binary"))
        at = (h % F.length("word")).cast("int")
        cut = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
        rows = rows.select(F.when(h % slip == 0, cut).otherwise(F.col("word")).alias("word")).filter(F.length("word") >= least)
    return rows.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= often)


def _bits(codes: np.ndarray) -> np.ndarray:
    """The mask with the one bit of each code point."""
    place = codes % BANDS * WIDE + 9 + codes // BANDS % (WIDE - 9)
    for k, c in enumerate(BY_USE):
        place = np.where(codes == ord(c), k % BANDS * WIDE + k // BANDS, place)
    return np.int64(1) << place


def masks(found: list[str]) -> np.ndarray:
    """The letter-parity mask of each word."""
    codes = np.frombuffer("".join(found).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    odd = np.concatenate([np.zeros(1, np.int64), np.bitwise_xor.accumulate(_bits(codes))])
    end = np.cumsum([len(w) for w in found], dtype=np.int64)
    return odd[end] ^ odd[np.concatenate([[0], end[:-1]])] if found else odd[:0]


def mask(word: Column | str) -> Column:
    """masks() of a column without nulls."""
    return F.arrow_udf(lambda x: pa.array(masks(x.to_pylist()), pa.int64()), "long")(word)


def near(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced code point makes one word the other."""
    if len(a) < len(b):
        a, b = b, a
    p = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(b))
    return a != b and (a[p + 1 :] == b[p + 1 :] if len(a) == len(b) else a[p + 1 :] == b[p:])


def halves(size: int) -> tuple[int, int]:
    """Letters of the first and of the last half, one of which an edit leaves in words of `size` letters."""
    return (size - 1) // 2, size - 1 - (size - 1) // 2


def _compare(found: list[str], n: np.ndarray, bits: np.ndarray, own: np.ndarray, side: np.ndarray, band: int, size: int, half: str, across: bool):
    """(a, b, n of a, n of b) of one group. `own` words have `size` letters, the others one fewer; `across`: pairs of
    one side and the other only."""
    q, r = halves(size)
    first = np.fromiter((hash(w[:q]) for w in found), np.int64, len(found))
    last = np.fromiter((hash(w[len(w) - r :]) for w in found), np.int64, len(found))
    left, right = (np.flatnonzero(side == 0), np.flatnonzero(side == 1)) if across else (np.arange(len(found)),) * 2
    for k in range(0, len(left), 256):
        rows = left[k : k + 256]
        close = np.bitwise_count(bits[rows][:, None] ^ bits[right]) <= 2
        close &= own[rows][:, None] | own[right]
        if not across:
            close &= rows[:, None] < right
        i, j = np.nonzero(close)
        i, j = rows[i], right[j]
        head = first[i] == first[j]
        good = (head | (last[i] == last[j])) if half != "s" else ~head & (last[i] == last[j])
        flips = bits[i] ^ bits[j]
        for lower in range(band):  # it is reported there
            good &= (flips >> (WIDE * lower)) & ((1 << WIDE) - 1) != 0
        for x, y in zip(i[good].tolist(), j[good].tolist()):
            if near(found[x], found[y]):
                yield found[x], found[y], int(n[x]), int(n[y])


def _pairs(batches):
    """Pairs of the groups of one task, whose rows come in the order of their keys."""
    settle()
    held: dict[str, list] = {}
    now = None

    def done():
        if len(held["word"]) > 1:
            fixed = {c: held[c][0] for c in ("band", "size", "half", "across")}
            arrays = (np.array(held["n"], np.int64), np.array(held["mask"], np.int64), np.array(held["own"], bool), np.array(held["side"], np.int8))
            yield from _compare(held["word"], *arrays, **fixed)

    def packed(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.string(), pa.string(), pa.int64(), pa.int64()))], ["a", "b", "an", "bn"])

    out: list[tuple] = []
    for batch in batches:
        columns = {c: batch[c].to_pylist() for c in batch.schema.names}
        keys = columns.pop("key")
        edges = [0, *(k for k in range(1, len(keys)) if keys[k] != keys[k - 1]), len(keys)]
        for x, y in zip(edges, edges[1:]):
            if x < y and keys[x] != now:
                if now is not None:
                    out += done()
                now, held = keys[x], {c: [] for c in columns}
            for c, v in columns.items():
                held[c] += v[x:y]
            if len(out) >= 10_000:
                yield packed(out)
                out = []
    if now is not None:
        out += done()
    if out:
        yield packed(out)
    held = {}
    tidy()


_GROUP = ("band", "part", "size")


def near_pairs(counted: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(a, b, an, bn) of every two near words of a stored (word, n, mask), each pair once, in either order."""
    chars = F.length("word")
    spots = F.explode(F.array(*[F.struct(F.lit(b).alias("band"), (chars + extra).alias("size")) for b in range(BANDS) for extra in (0, 1)]))
    rows = counted.select("word", "n", "mask", spots.alias("s")).select("word", "n", "mask", "s.band", "s.size")
    rows = rows.withColumn("part", F.expr(f"shiftright(mask, band * {WIDE}) & {(1 << WIDE) - 1}")).withColumn("own", F.length("word") == F.col("size"))

    def crowds(df: DataFrame, by: tuple) -> DataFrame:
        return sized(stash(df.groupBy(*by).agg(F.count("*").alias("m")).filter(F.col("m") > crowd), "crowds"))

    # Crowded groups by halves of the words.
    q = F.expr("(size - 1) div 2").cast("int")
    r = (F.col("size") - 1 - q).cast("int")
    two = F.array(
        F.struct(F.lit("p").alias("half"), F.substring("word", F.lit(1), q).alias("tail")),
        F.struct(F.lit("s").alias("half"), F.substring("word", F.length("word") - r + 1, r).alias("tail")),
    )
    whole = F.array(F.struct(F.lit("").alias("half"), F.lit("").alias("tail")))
    rows = rows.join(crowds(rows, _GROUP), list(_GROUP), "left").withColumn("h", F.explode(F.when(F.col("m").isNull(), whole).otherwise(two)))
    rows = rows.select("word", "n", "mask", *_GROUP, "own", "h.half", "h.tail")
    # What is crowded still, in blocks of which two meet at a time.
    by = (*_GROUP, "half", "tail")
    rows = rows.join(crowds(rows.filter("half <> ''"), by), list(by), "left")
    blocks = F.ceil(F.coalesce("m", F.lit(1)) / crowd).cast("int")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("word"), blocks).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    rows = rows.withColumn("across", F.col("block") != F.col("other")).withColumn("side", F.when(F.col("block") > F.col("other"), 1).otherwise(0))
    key = F.concat_ws("|", "band", "part", "size", F.least("block", "other"), F.greatest("block", "other"), "half", "tail")
    rows = rows.select(key.alias("key"), "word", "n", "mask", "band", "size", "half", "own", "across", "side")
    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(_pairs, "a string, b string, an long, bn long")


def _roots(links: DataFrame) -> DataFrame:
    """(word, root): the end of each word's chain of forms. Each round doubles the links that a word has followed; a
    form is several times as frequent as its word, so chains are short."""
    at = stash(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = at.select(F.col("word").alias("w"), F.col("root").alias("onward"))
        at = stash(at.join(on, F.col("root") == F.col("w"), "left").select("word", F.coalesce("onward", "root").alias("root"), F.col("onward").isNotNull().alias("moved")), "roots")
        moved = at.filter("moved").limit(1).count()
        at = at.select("word", "root")
        if not moved:
            return at


def variants(counted: DataFrame, ratio: int = 5, crowd: int = CROWD) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of (word, n). A word's form is its near word of largest n,
    the first in code-point order among equals, if that n is `ratio` times the word's at least; root is where the
    forms lead. Rows of one word are added up, rows without a word or number are left out."""

    def build() -> DataFrame:
        rows = counted.filter("word IS NOT NULL AND n IS NOT NULL").groupBy("word").agg(F.sum("n").cast("long").alias("n"))
        known = stash(rows.withColumn("mask", mask("word")), "words")
        pairs = stash(near_pairs(known, crowd), "pairs")
        both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("bn").alias("m")).unionAll(pairs.select("b", "a", "an"))
        # The least of (-n, word) is the most frequent, the first of equals.
        best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "other")).alias("best"))
        rows = known.select("word", "n").join(best, "word", "left")
        takes = -F.col("best.m") >= ratio * F.col("n")
        rows = rows.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(takes, F.col("best.other")).alias("form"), F.when(takes, -F.col("best.m")).alias("form_n"))
        rows = stash(rows, "forms")
        out = rows.join(_roots(rows.filter("form IS NOT NULL")), "word", "left")
        return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

    return settled(build, counted.sparkSession, "variants")
