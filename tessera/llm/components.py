"""Connected components by alternating large-star and small-star steps.

Up to ONE_TASK edges are joined by union-find in one task, in bounded memory; more go through the
steps. Each step is an aggregate and a join on the edges; nothing is gathered per node, so a node with a
great many links is no hot group, and each round is written out, so lineage stays short.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.work import stash

ONE_TASK = 500_000


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large: every greater neighbour of u goes to the least of u and its neighbours. Small: u and its
    lesser neighbours do. Edges are (u, v) in either direction."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    joined = both.join(least, "u")
    if large:
        out = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.filter("v < u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        out = out.unionAll(joined.filter("m < u").select("u", F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def _union(batches):
    """(node, label) of the edges of one task."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while (up := root.setdefault(top, top)) != top:
            top = up
        while root[x] != top:
            root[x], x = top, root[x]
        return top

    for batch in batches:
        for u, v in zip(batch["u"].to_pylist(), batch["v"].to_pylist()):
            a, b = find(u), find(v)
            root[max(a, b)] = min(a, b)
    nodes = list(root)
    for k in range(0, len(nodes), 50_000):
        part = nodes[k : k + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([find(x) for x in part], pa.int64())], ["node", "label"])


def components(links: DataFrame, one_task: int = ONE_TASK) -> DataFrame:
    """(node, label) of every node of links (a long, b long): label is the least node of its component."""
    edges, before = stash(links.select(F.col("a").alias("u"), F.col("b").alias("v")).filter("u <> v"), "edges"), None
    if edges.count() <= one_task:
        return edges.coalesce(1).mapInArrow(_union, "node long, label long")
    while True:
        edges = stash(_star(_star(edges, True), False), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    found = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return found.unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("label"))).groupBy("node").agg(F.min("label").alias("label"))
