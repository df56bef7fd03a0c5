"""Mixing sources to target weights by pivotal dependent rounding.

Each source's target is a share of the words wanted, by weight, capped at a multiple of what it has
(the excess goes to the others by weight). A document's fractional copies are target / source size.
Pivotal rounding pairs two fractional documents and moves words from one to the other, in a random
direction that leaves both expectations as they are, until one of them is integral; what is left goes
on to the next pair. A source's words are so kept exactly, but for one last document. Leaves are
hash groups of a source's documents, equal rows in groups of a leaf's size; each leaf's residual, one document at
most, goes up a tree.

Random numbers are hashes of the rows, so reruns and retried tasks agree.

Defined results: a null or empty text has size 0 and takes nothing; a null source is a source, last
in order; repeated rows are units of their own; an empty table gives no rows. Other columns do not
matter to plan(); apply() carries them.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.work import settled, sized, stash

WORD = r"[^\x20\x09-\x0D]+"
#: Documents of a leaf, and leaves that meet in a group one level up.
LEAF, FAN = 4096, 64
_M = (1 << 64) - 1


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(totals: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Adds target to (source, source_size): min(most * size, level * weight), where the level makes
    the targets' sum share * all sizes. Its windows hold one row a source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    k = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (k + 1).cast("int"))
    out = totals.withColumn("w", w).withColumn("rank", F.row_number().over(by_name)).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    rise = Window.orderBy(F.col("cap") / F.col("w"), "rank")
    before = F.coalesce(F.sum("cap").over(rise.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("w").over(rise.rowsBetween(0, Window.unboundedFollowing))
    whole = Window.partitionBy()
    level = (F.sum("source_size").over(whole) * F.lit(float(share)) - before) / rest
    out = out.withColumn("level", level)
    # The sources below the level are full; the first that is not sets it.
    free = F.min(F.when(F.col("level") * F.col("w") <= F.col("cap"), F.struct(F.col("cap") / F.col("w"), "rank", "level"))).over(whole)
    return out.select("source", "rank", "source_size", "n", F.coalesce(F.least("cap", free.getField("level") * F.col("w")), "cap").alias("target"))


def _random(a: int, b: int, seed: int) -> float:
    """In [0, 1), from two row hashes."""
    x = (a * 0x9E3779B97F4A7C15 + b * 0xC2B2AE3D27D4EB4F + seed * 0x165667B19E3779F9 + 1) & _M
    for m in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        x = ((x ^ (x >> 30)) * m) & _M
    return ((x ^ (x >> 31)) >> 11) / (1 << 53)


def pivot(a: list, b: list, seed: int) -> None:
    """One step on units [p, size, hash]: words move between a and b until one p is 0 or 1."""
    (pa_, sa, ha), (pb, sb, hb) = a, b
    to_a, to_b = min((1 - pa_) * sa, pb * sb), min((1 - pb) * sb, pa_ * sa)
    gain, give, moved = (a, b, to_a) if _random(ha, hb, seed) * (to_a + to_b) < to_b else (b, a, to_b)
    up, down = gain[0] + moved / gain[1], give[0] - moved / give[1]
    full, empty = (1 - gain[0]) * gain[1] <= moved, give[0] * give[1] <= moved
    gain[0], give[0] = (1.0 if full else min(up, 1.0)), (0.0 if empty else max(down, 0.0))


_ROW = "doc_id long, source string, size long, u long, source_size long, target double, rank int, leaf long, base long, p double, copies long"


def _reduce(df: DataFrame, seed: int, last: bool) -> DataFrame:
    """Pivots within (rank, leaf) in the order of the row hashes; a task holds one unit at a time.
    The unit a group leaves fractional has null copies, or is rounded by its own hash if last."""
    names = [x.split()[0] for x in _ROW.split(", ")]

    def run(batches):
        now, held = None, None  # held: (row, unit)

        def close(row, unit):
            p = unit[0]
            if last and 0 < p < 1:
                p = float(_random(unit[2], 7, seed) < p)
            row["p"], row["copies"] = p, row["base"] + int(p) if p in (0.0, 1.0) else None
            return row

        for batch in batches:
            out = []
            for row in batch.to_pylist():
                unit = [row["p"], row["size"], row["u"] & _M]
                if (row["rank"], row["leaf"]) != now:
                    if held:
                        out.append(close(*held))
                    now, held = (row["rank"], row["leaf"]), None
                if unit[0] in (0.0, 1.0) or not unit[1]:
                    row["copies"] = row["base"] + int(unit[0] == 1.0)
                    out.append(row)
                    continue
                if held:
                    pivot(held[1], unit, seed)
                    fractional = []
                    for r, u in (held, (row, unit)):
                        if u[0] in (0.0, 1.0):
                            out.append(close(r, u))
                        else:
                            fractional.append((r, u))
                    held = fractional[0] if fractional else None
                else:
                    held = (row, unit)
            if out:
                yield pa.RecordBatch.from_pylist(out, batch.schema)
                schema = batch.schema
        if held:
            row = close(*held)
            kinds = {"doc_id": pa.int64(), "source": pa.string(), "target": pa.float64(), "p": pa.float64(), "rank": pa.int32()}
            yield pa.RecordBatch.from_arrays([pa.array([row[n]], kinds.get(n, pa.int64())) for n in names], names)

    dealt = df.repartition("rank", "leaf")
    if "times" in df.columns:  # equal rows come as one, and are told apart where they are used
        dealt = dealt.withColumn("time", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    return dealt.select(*names).sortWithinPartitions("rank", "leaf", "u").mapInArrow(run, _ROW)


def plan(df: DataFrame, id_col: str = "doc_id", source: str = "source", text: str = "text", weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: int = 0, leaf: int = LEAF) -> DataFrame:
    """(doc_id, source, size, u, source_size, target, copies) of each row; u is a hash of id and text.

    Texts are read once; what is stored and shuffled is a few numbers a row.
    """
    return settled(lambda: _plan(df, id_col, source, text, weights, share, most, seed, leaf), df.sparkSession, "mix")


def _plan(df: DataFrame, id_col: str, source: str, text: str, weights: tuple[int, ...], share: float, most: float, seed: int, leaf: int) -> DataFrame:
    c = lambda n: F.col(f"`{n}`")
    each = df.select(c(id_col).cast("long").alias("doc_id"), c(source).cast("string").alias("source"), word_count(c(text)).alias("size"), F.xxhash64(c(id_col), c(source), c(text)).alias("u"))
    rows = stash(each.groupBy("doc_id", "source", "size", "u").agg(F.count("*").alias("m")), "sizes")
    totals = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("m")).alias("source_size"), F.sum("m").alias("n"))
    aims = stash(targets(totals, weights, share, most), "targets").withColumnRenamed("source", "_s")
    joined = rows.join(sized(aims), F.col("source").eqNullSafe(F.col("_s")))
    f = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    leaves = F.ceil(F.col("n") / F.lit(leaf))
    # Equal rows fill a leaf at most, and the next of them go to another.
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("m") - 1) / F.lit(leaf))))
    level = joined.withColumn("f", f).withColumn("part", part).select(
        "doc_id", "source", "size", "u", "source_size", "target", "rank", F.pmod(F.xxhash64("u", "part"), leaves).cast("long").alias("leaf"),
        F.floor("f").cast("long").alias("base"), (F.col("f") - F.floor("f")).alias("p"), F.lit(None).cast("long").alias("copies"),
        F.least(F.lit(leaf).cast("long"), F.col("m") - F.col("part") * leaf).alias("times"),
    )
    groups = int(aims.agg(F.max(F.ceil(F.col("n") / F.lit(leaf)))).first()[0] or 0)
    done = []
    while True:
        out = stash(_reduce(level, seed, groups <= 1), "pivots")
        done.append(out.filter("copies IS NOT NULL"))
        if groups <= 1:
            break
        level = out.filter("copies IS NULL").withColumn("leaf", F.floor(F.col("leaf") / FAN).cast("long"))
        groups, seed = -(-groups // FAN), seed + 1
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    return found.select("doc_id", "source", "size", "u", "source_size", "target", "copies")


def apply(df: DataFrame, id_col: str = "doc_id", source: str = "source", text: str = "text", **kw) -> DataFrame:
    """The mixed rows of df: each as often as its copies, columns unchanged. Equal rows share their
    copies out by number; one shuffle by (id, hash) serves the join and that numbering."""
    c = lambda n: F.col(f"`{n}`")
    chosen = plan(df, id_col, source, text, **kw).groupBy(F.col("doc_id").alias("_i"), F.col("u").alias("_h")).agg(
        F.min("copies").alias("_lo"), F.max("copies").alias("_hi"), F.sum("copies").alias("_sum"), F.count("*").alias("_n")
    )
    rows = df.select(F.struct(*[c(x) for x in df.columns]).alias("row"), c(id_col).cast("long").alias("_id"), F.xxhash64(c(id_col), c(source), c(text)).alias("_u"))
    both = rows.join(chosen, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_u") == F.col("_h")))
    nth = F.row_number().over(Window.partitionBy("_id", "_u").orderBy("_lo"))
    high = F.col("_sum") - F.col("_lo") * F.col("_n")
    copies = F.when(nth <= high, F.col("_hi")).otherwise(F.col("_lo"))
    return both.withColumn("_c", copies).filter("_c > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("_c").cast("int"))).alias("_k")).select("row.*")
