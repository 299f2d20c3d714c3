"""Near duplicates of embeddings by iterative quantisation and multi-index Hamming tables.

1. A rotation of the principal directions, learned on a bounded sample, gives
   balanced binary codes of up to 64 bits.
2. Distinct codes are indexed in four tables by 16-bit parts, each part with
   its 16 neighbours at distance one. Codes within 11 bits of each other agree
   up to two bits in some part and so meet in a table (the pigeonhole rule of
   multi-index hashing). Codes that meet within ``RADIUS`` bits are joined to cells.
3. Within a cell all original vectors are compared, block by block, by cosine
   in double precision: links are counted per vector and only links that join
   components are kept. Equal vectors are compared once, with their number.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reckon.llm.common import partitions
from reckon.llm.components import UnionFind, chunk_pairs, components, sorted_groups
from reckon.session import cut_lineage

#: Vectors that the rotation learns from, at most (those with the smallest hash of the id).
SAMPLE = 20_000
BITS, PARTS, RADIUS = 64, 4, 14


def fit_itq(x: np.ndarray, bits: int = BITS, rounds: int = 50, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Mean, and projection (principal directions, then the rotation that brings them closest to signs)."""
    rng = np.random.default_rng(seed)
    mean = x.mean(0)
    x = x - mean
    values, vectors = np.linalg.eigh(x.T @ x / len(x))
    w = vectors[:, ::-1][:, : min(bits, x.shape[1])]
    v = x @ w
    r = np.linalg.qr(rng.normal(size=(w.shape[1], w.shape[1])))[0]
    for _ in range(rounds):
        u, _, t = np.linalg.svd(np.sign(v @ r).T @ v)
        r = (u @ t).T
    return mean, w @ r


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def codes(x: np.ndarray, mean: np.ndarray, projection: np.ndarray) -> np.ndarray:
    bit = ((unit(x) - mean) @ projection > 0).astype(np.uint64)
    return (bit << np.arange(bit.shape[1], dtype=np.uint64)).sum(1, dtype=np.uint64)


def index_keys(code: np.ndarray) -> np.ndarray:
    """For each code the keys of its parts and of their neighbours at distance one, each with the table's number."""
    width = BITS // PARTS
    near = np.concatenate([[0], 1 << np.arange(width)]).astype(np.int64)
    part = ((code[:, None] >> (np.arange(PARTS, dtype=np.uint64) * np.uint64(width))) & np.uint64((1 << width) - 1)).astype(np.int64)
    return (((part[:, :, None] ^ near) << 2) | np.arange(PARTS)[None, :, None]).reshape(len(code), -1)


def _matrix(column: pa.ChunkedArray) -> list[np.ndarray]:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat, at = column.flatten().to_numpy(), np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))])
    return [flat[a:b] for a, b in zip(at[:-1], at[1:])]


def _stars(joined: UnionFind, rid: np.ndarray) -> pa.RecordBatch | None:
    root = joined.roots()
    far = np.flatnonzero(root != np.arange(len(root)))
    return pa.RecordBatch.from_arrays([pa.array(rid[far]), pa.array(rid[root[far]])], ["u", "v"]) if len(far) else None


def _join_blocks(linked: np.ndarray, joined: UnionFind, left: np.ndarray, right: np.ndarray) -> None:
    """Unites along ``linked`` (rows: left, columns: right); a row already with all its partners is passed over."""
    for i in np.flatnonzero(linked.any(1)):
        own, partners = joined.find(int(left[i])), right[linked[i]]
        for j in partners[joined.up[partners] != own].tolist():
            joined.union(int(left[i]), j)


def _meet(batches):
    """Codes of a bucket within the radius, as stars."""
    for _, rows in sorted_groups(batches, "key", "lo", "hi"):
        rid, code, chunk = (rows.column(c).to_numpy() for c in ("rid", "code", "chunk"))
        if len(rid) < 2:
            continue
        code, joined = code.view(np.uint64), UnionFind(len(rid))
        left, right = np.flatnonzero(chunk == chunk.min()), np.flatnonzero(chunk == chunk.max())
        for k in range(0, len(left), 1024):
            part = left[k : k + 1024]
            _join_blocks(np.bitwise_count(code[part][:, None] ^ code[right][None]) <= RADIUS, joined, part, right)
        if (out := _stars(joined, rid)) is not None:
            yield out


def _linked(threshold: float):
    def linked(batches):
        """For each vector of a cell the linked others (with their numbers), and stars of links: n = 0 in these."""
        for key, rows in sorted_groups(batches, "cell", "dim", "lo", "hi"):
            rid, number, chunk = (rows.column(c).to_numpy() for c in ("rid", "copies", "chunk"))
            x = np.stack(_matrix(rows.column("x")))
            x = x / np.abs(x).max(1, keepdims=True)
            norm, joined, count = np.sqrt((x * x).sum(1)), UnionFind(len(rid)), np.zeros(len(rid), np.int64)
            two = key[2] != key[3]
            left = np.flatnonzero(chunk == key[2])
            right = np.flatnonzero(chunk == key[3])
            for k in range(0, len(left), 512):
                part = left[k : k + 512]
                link = (x[part] @ x[right].T) / (norm[part][:, None] * norm[right][None]) >= threshold
                if not two:
                    link[np.arange(len(part)), k + np.arange(len(part))] = False
                count[part] += link @ number[right]
                if two:
                    count[right] += number[part] @ link
                _join_blocks(link, joined, part, right)
            some = count > 0
            m = int(some.sum())
            if m:
                yield pa.RecordBatch.from_arrays([pa.array(rid[some]), pa.nulls(m, pa.int64()), pa.array(count[some])], ["u", "v", "n"])
                star = _stars(joined, rid)
                if star is not None:
                    yield pa.RecordBatch.from_arrays([*star.columns, pa.array(np.zeros(star.num_rows, np.int64))], ["u", "v", "n"])

    return linked


def embedding_dedup(vectors: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id, kept, one row per input row.

    Vectors link when their cosine, in double precision, is at least
    ``threshold``; only vectors of equal length can. Vectors that are null,
    empty, zero or hold null or non-finite components link with nothing: 0
    links, their own component, kept. component_id is the smallest id reachable,
    kept is vec_id = component_id (a null id is never kept by others, and is kept
    alone). Repeated rows link with each other. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    n_parts = partitions(spark)
    x = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x"))
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists("x", lambda c: c != 0)
    # -0.0 and 0.0 are the same component
    x = x.withColumn("x", F.when(F.coalesce(finite, F.lit(False)), F.transform("x", lambda c: F.when(c == 0, F.lit(0.0)).otherwise(c))))
    bad = x.filter("x is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    good = x.filter("x is not null")
    sample = [np.array(r.x) for r in good.orderBy(F.xxhash64("vec_id"), F.xxhash64("x")).limit(SAMPLE).toLocalIterator()]
    if not sample:
        return bad
    dims = [len(s) for s in sample]
    dim = max(set(dims), key=dims.count)
    model = spark.sparkContext.broadcast(fit_itq(unit(np.stack([s for s in sample if len(s) == dim]))))  # 64 x 65 numbers a vector's length long

    def coded(batches):
        for b in batches:
            rows = np.zeros((b.num_rows, dim))
            for i, v in enumerate(_matrix(b.column("x"))):
                rows[i, : min(dim, len(v))] = v[:dim]
            rows[~rows.any(1)] = 1.0  # nothing left of a longer vector
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(codes(rows, *model.value).view(np.int64))], [*b.schema.names, "code"])

    classes = good.groupBy("x").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
    classes = cut_lineage(classes.mapInArrow(coded, "x array<double>, least long, copies long, code long")).withColumn("rid", F.monotonically_increasing_id()).withColumn("dim", F.size("x"))
    leaders = classes.groupBy("code").agg(F.min("rid").alias("lead"))

    def indexed(batches):
        for b in batches:
            key = index_keys(b.column("code").to_numpy().view(np.uint64))
            each = lambda c: pa.array(np.repeat(b.column(c).to_numpy(), key.shape[1]))
            yield pa.RecordBatch.from_arrays([pa.array(key.ravel()), each("lead"), each("code")], ["key", "rid", "code"])

    held = cut_lineage(leaders.select("lead", "code").mapInArrow(indexed, "key long, rid long, code long"))
    met = chunk_pairs(held, "key", "rid").repartition(n_parts, "key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
    cell = components(met.mapInArrow(_meet, "u long, v long").distinct()).select(F.col("node").alias("lead"), F.col("component").alias("cell"))
    members = classes.join(leaders, "code").join(cell, "lead", "left").select("rid", "copies", "dim", "x", F.coalesce("cell", "lead").alias("cell"))
    # cells and lengths of one vector have nothing to compare
    several = members.groupBy("cell", "dim").agg(F.count("*").alias("n")).filter("n > 1").select("cell", "dim")
    members = members.join(several, ["cell", "dim"])
    pairs = chunk_pairs(members, "cell", "rid").repartition(n_parts, "cell", "dim", "lo", "hi").sortWithinPartitions("cell", "dim", "lo", "hi")
    found = cut_lineage(pairs.mapInArrow(_linked(threshold), "u long, v long, n long"))
    links = found.filter("v is null").groupBy(F.col("u").alias("rid")).agg(F.sum("n").alias("links"))
    comp = components(found.filter("v is not null").select("u", "v")).select(F.col("node").alias("rid"), F.col("component").alias("comp"))
    known = classes.select("rid", "x", "least", "copies").join(comp, "rid", "left").join(links, "rid", "left").withColumn("comp", F.coalesce("comp", "rid"))
    top = known.groupBy("comp").agg(F.min("least").alias("component_id"))
    known = known.join(top, "comp").select("x", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).cast("long").alias("n_links"), "component_id")
    out = good.join(known, "x").select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"))
    return out.unionByName(bad)
