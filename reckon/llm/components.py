"""Connected components and chunked group joins, both safe for hot groups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reckon.session import cut_lineage


class UnionFind:
    """Over 0..n-1; the root of a set is its smallest member."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def find(self, x: int) -> int:
        root = x
        while self.up[root] != root:
            root = self.up[root]
        while self.up[x] != root:
            self.up[x], x = root, self.up[x]
        return int(root)

    def union(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True

    def roots(self) -> np.ndarray:
        while True:
            up = self.up[self.up]
            if np.array_equal(up, self.up):
                return up
            self.up = up


def _contract(batches: Iterator[pa.RecordBatch]):
    """Of each batch's edges, a star from every node to the smallest it is linked to there."""
    for b in batches:
        u, v = b.column("u").to_numpy(), b.column("v").to_numpy()
        node, at = np.unique(np.concatenate([u, v]), return_inverse=True)
        sets = UnionFind(len(node))
        for x, y in zip(at[: len(u)].tolist(), at[len(u) :].tolist()):
            sets.union(x, y)
        root = node[sets.roots()]
        far = root != node
        yield pa.RecordBatch.from_arrays([pa.array(node[far]), pa.array(root[far])], ["u", "v"])


def components(edges: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) for all nodes of ``edges``
    (u long, v long) but the smallest of each component.

    Alternating large-star and small-star steps: each is a partial-aggregated
    minimum per node and a join on the node (a hot node is split by the
    skew-join rule); a node's edges are never gathered. Every step is written
    to the shared checkpoint folder, so lost executors cost one step at most.
    Null nodes and loops are ignored; no edges give no rows.
    """
    e = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v")
    e, before = cut_lineage(e.mapInArrow(_contract, "u long, v long").distinct()), None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        e = cut_lineage(small.filter("u > v").distinct())
        now = e.agg(F.count("*"), F.countDistinct("u"), F.sum(F.col("v").cast("decimal(38,0)"))).first()
        if now[0] == now[1] and (now == before or now[0] == 0):
            return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = now


#: Rows of a group that one task may hold of either side.
CHUNK = 4096


def chunk_pairs(rows: DataFrame, group: str, row_id: str) -> DataFrame:
    """Deals the rows of each group to chunks of about ``CHUNK`` by a hash of
    ``row_id`` and repeats them for each pair of chunks that they are part of:
    adds chunk, lo, hi. Any two rows of a group meet in exactly one (group, lo, hi)
    in which one is of chunk lo and the other of chunk hi. Small groups are one chunk."""
    n = rows.groupBy(group).agg(F.ceil(F.count("*") / F.lit(CHUNK)).cast("int").alias("chunks")).filter("chunks > 1")
    out = rows.join(n, group, "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    out = out.withColumn("chunk", F.pmod(F.xxhash64(row_id), F.col("chunks")).cast("int"))
    out = out.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return out.withColumn("lo", F.least("chunk", "other")).withColumn("hi", F.greatest("chunk", "other")).drop("chunks", "other")


def sorted_groups(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[tuple[tuple, pa.Table]]:
    """Groups of a stream that is sorted by ``keys``, one at a time."""
    held, key = [], None
    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(b.num_rows, bool)
        change[0] = True
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        at = [*np.flatnonzero(change).tolist(), b.num_rows]
        for lo, hi in zip(at[:-1], at[1:]):
            now = tuple(c[lo] for c in cols)
            if key is not None and now != key:
                yield key, pa.Table.from_batches(held)
                held = []
            key = now
            held.append(b.slice(lo, hi - lo))
    if held:
        yield key, pa.Table.from_batches(held)
