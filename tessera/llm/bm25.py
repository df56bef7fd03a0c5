"""Exact BM25 top-k over a sharded inverted index with block-max dynamic pruning.

A shard is the index of a bounded run of rows: postings by term, and for each term and block of rows
the greatest term weight (tf part of BM25). Document frequencies, the number of rows and the mean
length are global, so scores of shards compare and the merge of their top k is exact.

A search is block-max WAND, set-wise instead of row by row. Given a threshold, the k-th score or less, a
query whose lists' greatest weights add up to less than it is done with the shard. The long lists are set
aside: rows are scored by the short ones, and a block without a row that the long lists' block maxima lift to
the threshold is skipped. The other blocks are scored in full, a block at a time for all queries that still
want it. Weights of long lists stand in a table by block, so that both their maxima and their scores are matrix
products in single precision, with room for its error; the rows near the threshold are scored again in double
precision. Rows of one commonest word and like lengths share blocks. Thresholds: in a shard the k-th
score by the rarest terms, then by the short lists; between shards the k-th score of the shards searched
before. About FIRST shards come first, then eight times as many, and so on, so later shards return few rows:
some 8 * k rows a query for each such step, however many shards.

Defined results: words are maximal runs of bytes other than ASCII white space, A-Z in lower case; a
query counts each distinct word as often as it occurs; a null or empty text has no words, matches
nothing and as a query returns nothing; ties go to the smaller id, null ids last; repeated rows are
rows of their own; queries that share an id and a text are one query, different texts under one id are
queries of their own under that id; rows that share no word with a query are not returned; an empty table
gives no rows. Words are told apart by 64-bit hashes: of n distinct words two share one with a probability
of n * n / 2 ** 65.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import batched

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.work import settle, settled, stash, tidy

#: Bytes of text in a shard; rows in a block; queries in one pass, and their distinct words; shards searched first.
SHARD, BLOCK, QUERIES, TERMS, FIRST = 16 << 20, 64, 4096, 2_000_000, 3
#: A long list has more than a LONG-th of the rows; most long lists of a shard, and their cells; cells scored at once.
LONG, LISTS, CELLS, AT_ONCE = 24, 1024, 8 << 20, 1 << 20
K1, B = 1.2, 0.75


class _Terms(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 150_000:
            self.clear()
        self[word] = t = int(np.uint64(xxhash.xxh64_intdigest(word)).view(np.int64))
        return t


_terms = _Terms()


def terms(text: bytes | None) -> tuple[np.ndarray, np.ndarray, int]:
    """(distinct term hashes, their counts, number of words)."""
    words = (text or b"").lower().split()
    t, n = np.unique(np.fromiter(map(_terms.__getitem__, words), np.int64, len(words)), return_counts=True)
    return t, n, len(words)


def _ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """lo[0], ..., hi[0] - 1, lo[1], ... end to end, and the lengths."""
    n = hi - lo
    return np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum())), n


class Shard:
    """Postings of a run of rows: terms sorted; rows and counts of each. `gather`: rows of one commonest word stand
    together, by length."""

    def __init__(self, ids: list, texts: list[bytes | None], gather: bool = False):
        found = [terms(t) for t in texts]
        if gather:
            lead = np.array([t[n.argmax()] if len(t) else 0 for t, n, _ in found], np.int64)
            order = np.lexsort(([n for _, _, n in found], lead)).tolist()
            ids, found = [ids[i] for i in order], [found[i] for i in order]
        self.ids = ids
        self.length = np.array([n for _, _, n in found], np.int32)
        flat = np.concatenate([t for t, _, _ in found]) if found else np.zeros(0, np.int64)
        row = np.repeat(np.arange(len(found), dtype=np.int32), [len(t) for t, _, _ in found])
        order = np.argsort(flat, kind="stable")
        self.terms, self.start = np.unique(flat[order], return_index=True)
        self.start = np.append(self.start, len(flat)).astype(np.int32 if len(flat) < 1 << 31 else np.int64)
        count = np.concatenate([n for _, n, _ in found])[order] if found else np.zeros(0, np.int32)
        # Kept in the narrowest types: a shard is stored and travels as one value.
        self.row, self.count = (x.astype(np.min_scalar_type(int(x.max(initial=0)))) for x in (row[order], count))

    def weigh(self, mean: float) -> None:
        """The part of BM25 that does not depend on the query, its maxima by term, and the table of the long
        lists with their maxima by block."""
        self.norm = K1 * (1 - B + B * self.length / (mean or 1.0))
        self.row = self.row.astype(np.int64)  # as numpy indexes
        self.weight = self.count * (K1 + 1) / (self.count + self.norm[self.row])
        self.greatest = np.maximum.reduceat(self.weight, self.start[:-1]) if len(self.terms) else np.zeros(0)
        rows, size = len(self.length), np.diff(self.start)
        blocks = -(-rows // BLOCK)
        long = np.flatnonzero(size > rows / LONG)
        long = np.sort(long[np.argsort(-size[long], kind="stable")[: min(LISTS, CELLS // max(rows, 1))]])
        self.long = np.full(len(self.terms), -1, np.int32)
        self.long[long] = np.arange(len(long))
        own, n = _ranges(self.start[long], self.start[long + 1])
        at = np.repeat(np.arange(len(long)), n), self.row[own]
        self.long_count = np.zeros((len(long), rows), self.count.dtype)
        self.long_count[at] = self.count[own]
        del self.count
        self.table = np.zeros((blocks, len(long), BLOCK), np.float32)
        self.table[at[1] // BLOCK, at[0], at[1] % BLOCK] = self.weight[own]
        self.most = np.ascontiguousarray(self.table.max(2).T)
        self.asked = np.zeros((max(AT_ONCE // max(blocks * BLOCK, 1), 1), len(long)), np.float32)

    def seed(self, at: np.ndarray, idf: np.ndarray, k: int) -> float:
        """A lower bound of the k-th score from the rarest of the terms `at`, whose postings are 4 * k at
        least; 0 if they have fewer than k rows."""
        n = self.start[at + 1] - self.start[at]
        rare = np.argsort(n, kind="stable")
        rare = rare[: 1 + np.searchsorted(np.cumsum(n[rare]), 4 * k)]
        own, n = _ranges(self.start[at[rare]], self.start[at[rare] + 1])
        rows, back = np.unique(self.row[own], return_inverse=True)
        if len(rows) < k:
            return 0.0
        score = np.bincount(back, np.repeat(idf[rare], n) * self.weight[own])
        return float(np.partition(score, len(score) - k)[len(score) - k])

    def find(self, words: np.ndarray) -> np.ndarray:
        """The places of term hashes among the shard's terms, -1 for others."""
        if not len(self.terms):
            return np.full(len(words), -1)
        at = np.minimum(np.searchsorted(self.terms, words), len(self.terms) - 1)
        return np.where(self.terms[at] == words, at, -1)

    def top(self, query: np.ndarray, idf: np.ndarray, k: int, least: float = 0.0) -> list[tuple[float, int]]:
        """The k best (score, row) of those whose score is `least` or more, exactly; query: term hashes, idf:
        their weights in this query."""
        at = self.find(query)
        return next(self.tops([(at[at >= 0], idf[at >= 0], least)], k))

    def tops(self, queries: Iterable[tuple[np.ndarray, np.ndarray, float]], k: int) -> Iterator[list[tuple[float, int]]]:
        """top() for each (places of terms, their weights, least)."""
        for some in batched(queries, len(self.asked)):
            yield from self._tops(some, k)

    def _tops(self, queries: tuple, k: int) -> Iterator[list[tuple[float, int]]]:
        near = 1 - 1e-9  # for sums in another order
        above = 1 + (len(self.most) + 8) * 2.0**-23  # for sums in single precision
        blocks = len(self.table)
        score, floor, asked = np.zeros((len(queries), blocks * BLOCK)), np.full(len(queries), np.inf), self.asked[: len(queries)]
        for i, (at, idf, least) in enumerate(queries):
            bar = (least or self.seed(at, idf, k)) * near
            if not len(at) or idf @ self.greatest[at] < bar:
                continue
            long = self.long[at]
            short = at[long < 0]
            asked[i, long[long >= 0]] = idf[long >= 0]
            own, n = _ranges(self.start[short], self.start[short + 1])
            score[i] = np.bincount(self.row[own], np.repeat(idf[long < 0], n) * self.weight[own], score.shape[1])
            if not least and k < score.shape[1]:
                bar = max(bar, float(np.partition(score[i], -k)[-k]) * near)
            floor[i] = bar
        reach = (score.reshape(len(queries), blocks, BLOCK).max(2) + asked @ self.most) * above
        live = (reach > 0) & (reach >= floor[:, None])
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        for b in np.flatnonzero(live.any(0)).tolist():
            i = np.flatnonzero(live[:, b])
            s = (score[i, b * BLOCK : (b + 1) * BLOCK] + asked[i] @ self.table[b]) * above
            q, r = np.nonzero((s > 0) & (s >= floor[i, None]))
            found.append((i[q], b * BLOCK + r, s[q, r]))
        asked[:] = 0.0
        q, row, most = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(q, kind="stable")
        edge = np.searchsorted(q[order], np.arange(len(queries) + 1))
        for i, (at, idf, _) in enumerate(queries):
            own = order[edge[i] : edge[i + 1]]
            if len(own) > k:  # the k-th of the upper bounds is below its own lower bound by their error at most
                own = own[most[own] >= np.partition(most[own], -k)[-k] * (2 - above) ** 2]
            yield self._exact(row[own], score[i], at, idf, floor[i], k)

    def _exact(self, hit: np.ndarray, score: np.ndarray, at: np.ndarray, idf: np.ndarray, least: float, k: int) -> list[tuple[float, int]]:
        """The k best of the rows `hit`, whose scores by the short lists are given."""
        idf, long = idf[self.long[at] >= 0][:, None], self.long[at][self.long[at] >= 0][:, None]
        score = score[hit]
        for a in range(0, len(hit) if len(long) else 0, 4096):
            n = self.long_count[long, hit[a : a + 4096]]
            score[a : a + 4096] += (idf * (n * (K1 + 1) / (n + self.norm[hit[a : a + 4096]]))).sum(0)
        hit, score = hit[score >= least], score[score >= least]
        if len(hit) > k:  # ties at the k-th place are kept for the ids to decide
            keep = score >= np.partition(score, -k)[-k] * (1 - 1e-12)
            hit, score = hit[keep], score[keep]
        best = list(zip(score.tolist(), hit.tolist()))
        best.sort(key=lambda x: (-round(x[0], 9), self.ids[x[1]] is None, self.ids[x[1]] or 0))
        return best[:k]


def _inputs(df: DataFrame, id_col: str, text: str) -> DataFrame:
    return df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))


def index(df: DataFrame, id_col: str = "doc_id", text: str = "text", shard: int = SHARD) -> DataFrame:
    """The stored shards: (shard, rows, words, blob) each."""

    def run(batches):
        settle()
        ids, texts, size, number = [], [], 0, TaskContext.get().partitionId() << 24

        def close():
            s = Shard(ids, texts, gather=True)
            return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([len(ids)]), pa.array([int(s.length.sum())]), pa.array([pickle.dumps(s, 5)], pa.binary())], ["shard", "rows", "words", "blob"])

        for batch in batches:
            for name, value in zip(batch["id"].to_pylist(), batch["text"]):
                ids.append(name)
                texts.append(value.as_buffer().to_pybytes() if value.is_valid else None)
                size += len(texts[-1] or b"")
                if size >= shard:
                    yield close()
                    ids, texts, size, number = [], [], 0, number + 1
        if ids:
            yield close()
        del ids, texts
        tidy(_terms)

    return stash(_inputs(df, id_col, text).mapInArrow(run, "shard long, rows long, words long, blob binary"), "shards", per_file=1)


def _frequencies(shards: DataFrame) -> DataFrame:
    """(t, df): each shard counts its own rows by term before they meet."""

    def run(batches):
        for batch in batches:
            for blob in batch["blob"]:
                s = pickle.loads(blob.as_buffer())
                n = np.diff(s.start)
                for k in range(0, len(n), 100_000):
                    yield pa.RecordBatch.from_arrays([pa.array(s.terms[k : k + 100_000]), pa.array(n[k : k + 100_000].astype(np.int64))], ["t", "n"])

    return shards.select("blob").mapInArrow(run, "t long, n long").groupBy("t").agg(F.sum("n").alias("df"))


def search(df: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id", text: str = "text", shard: int = SHARD, per_pass: int = QUERIES) -> DataFrame:
    """(query_id, doc_id, score, rank): the k best rows of df for each row of queries.

    Queries go in passes: a pass broadcasts at most per_pass queries, and fewer where their distinct
    words exceed TERMS, and frees them when it ends; each pass visits every shard once.
    """
    return settled(lambda: _search(df, queries, k, id_col, text, shard, per_pass), df.sparkSession, "found")


def _search(df: DataFrame, queries: DataFrame, k: int, id_col: str, text: str, shard: int, per_pass: int) -> DataFrame:
    spark = df.sparkSession
    shards = index(df, id_col, text, shard)
    n, words, number = shards.agg(F.sum("rows"), F.sum("words"), F.count("*")).first()
    if not n or not words:
        return spark.createDataFrame([], "query_id long, doc_id long, score double, rank long")
    mean = words / n

    def split(x: pa.Array) -> pa.Array:
        found = [terms(v) for v in x.cast(pa.large_binary()).to_pylist()]
        return pa.array([[{"t": int(a), "n": int(b)} for a, b in zip(t, c)] for t, c, _ in found], pa.list_(pa.struct([("t", pa.int64()), ("n", pa.int64())])))

    asked = _inputs(queries, id_col, text).select(F.col("id").alias("q"), F.xxhash64("text").alias("h"), F.explode(F.arrow_udf(split, "array<struct<t: long, n: long>>")("text")).alias("x")).select("q", "h", "x.t", "x.n")
    asked = asked.groupBy("q", "h", "t").agg(F.max("n").alias("n"))
    idf = F.log1p((F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighed = stash(asked.join(_frequencies(shards), "t").select("q", "h", "t", (idf * F.col("n")).alias("w")), "queries")
    total, pairs = weighed.agg(F.countDistinct("h", "q"), F.count("*")).first()
    passes = max(-(-total // per_pass), -(-pairs // TERMS), 1)
    lots = shards.withColumn("lot", F.pmod(F.xxhash64("shard"), F.lit(1 << 30)) / F.lit(float(1 << 30)) * F.lit(number))
    order = Window.partitionBy("query_id", "h").orderBy(F.desc(F.round("score", 9)), F.col("doc_id").asc_nulls_last())
    out = []
    for p in range(passes):
        own = weighed.filter(F.pmod(F.xxhash64("q", "h"), F.lit(passes)) == p).toArrow()
        asked = Asked(*[own[c].combine_chunks() for c in ("q", "h", "t", "w")])
        del own
        best, lo, hi = None, 0, FIRST
        while lo < number:
            sent = spark.sparkContext.broadcast(asked)
            part = lots.filter((F.col("lot") >= lo) & (F.col("lot") < hi) if hi < number else F.col("lot") >= lo)
            found = part.select("blob").mapInArrow(_searcher(sent, mean, k), "query_id long, h long, doc_id long, score double")
            found = found if best is None else best.drop("rank").unionAll(found)
            best = stash(found.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= k), "best")
            sent.destroy()
            lo, hi = hi, hi * 8
            if lo < number:
                last = best.filter(F.col("rank") == k).toArrow()
                asked.raise_to(*[last[c].combine_chunks() for c in ("query_id", "h", "score", "doc_id")])
        out.append(best)
    return reduce(DataFrame.unionAll, out).select("query_id", "doc_id", "score", "rank")


class Asked:
    """The queries of a pass: terms and weights end to end, and the k-th place of each query so far."""

    def __init__(self, q: pa.Array, h: pa.Array, t: pa.Array, w: pa.Array):
        none, q, h, t, w = q.is_null().to_numpy(zero_copy_only=False), q.fill_null(0).to_numpy(), h.to_numpy(), t.to_numpy(), w.to_numpy()
        order = np.lexsort((t, h, q, none))
        none, q, h = none[order], q[order], h[order]
        new = np.concatenate([[True], (none[1:] != none[:-1]) | (q[1:] != q[:-1]) | (h[1:] != h[:-1])]) if len(q) else np.zeros(0, bool)
        edge = np.flatnonzero(new)
        self.names = [(None if x else a, b) for x, a, b in zip(none[edge].tolist(), q[edge].tolist(), h[edge].tolist())]
        self.edge, self.w = np.append(edge, len(q)), w[order]
        self.words, at = np.unique(t[order], return_inverse=True)
        self.at = at.astype(np.int32)
        self.least: dict = {}

    def raise_to(self, q: pa.Array, h: pa.Array, score: pa.Array, doc: pa.Array) -> None:
        self.least = {(a, b): (s, d) for a, b, s, d in zip(q.to_pylist(), h.to_pylist(), score.to_pylist(), doc.to_pylist())}

    def found(self, place: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
        """Each query for Shard.tops(), from the places of `words`."""
        for name, a, z in zip(self.names, self.edge[:-1].tolist(), self.edge[1:].tolist()):
            at = place[self.at[a:z]]
            yield at[at >= 0], self.w[a:z][at >= 0], self.least.get(name, (0.0, None))[0]


def _searcher(sent, mean: float, k: int):
    def run(batches):
        settle()
        asked: Asked = sent.value
        for batch in batches:
            for blob in batch["blob"]:
                s = pickle.loads(blob.as_buffer())
                s.weigh(mean)
                at, rows = s.find(asked.words), []
                for name, best in zip(asked.names, s.tops(asked.found(at), k)):
                    least, last = asked.least.get(name, (0.0, None))
                    for x, r in best:
                        # A tie with the k-th place so far counts only before its id.
                        if least and round(x, 9) == round(least, 9) and last is not None and (s.ids[r] is None or s.ids[r] >= last):
                            continue
                        rows.append((*name, s.ids[r], x))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.float64()))], ["query_id", "h", "doc_id", "score"])
        tidy()

    return run
