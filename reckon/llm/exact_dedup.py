"""Exact duplicates by a Golomb-coded fingerprint exchange.

1. Each task sorts the distinct fingerprints of its documents (the head of
   the SHA-256 of the normalised bytes) and sends each owner its range as
   Golomb-Rice coded gaps, with one bit for "more than one here".
2. The owner returns a bitmap to each sender: which of its fingerprints
   occur more than once anywhere.
3. Only suspects (rows whose bit is set) have their bytes shuffled: texts
   are grouped by their bytes, so equal fingerprints alone decide nothing.

A hot text costs its owner one code per sending packet, and the byte check
collapses its copies before the shuffle.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reckon.llm.common import batch, byte_texts, partitions, release, rows_of, runs, task_id
from reckon.session import cut_lineage

#: Documents of one packet, bits of a fingerprint, bits of the filter that
#: picks the texts to shuffle (1 MB; too small a filter only shuffles more).
PACKET_DOCS, FP_BITS, FILTER_BITS = 200_000, 48, 1 << 23
SALTS = 16

_ROW = pa.schema([("kind", pa.int32()), ("part", pa.int64()), ("owner", pa.int32()), ("rank", pa.int64()), ("doc_id", pa.int64()), ("sha", pa.binary()), ("fp", pa.int64()), ("payload", pa.binary())])
_DDL = "kind int, part long, owner int, rank long, doc_id long, sha binary, fp long, payload binary"


def golomb_encode(gaps: np.ndarray) -> bytes:
    """Golomb codes with a power of two as divisor: 4 bytes with the number,
    1 with the shift, the quotients in unary, then the remainders."""
    n = len(gaps)
    k = int(max(0, np.floor(np.log2(max(1.0, float(gaps.astype(np.float64).mean())))))) if n else 0
    head = n.to_bytes(4, "little") + bytes([k])
    if not n:
        return head
    q = (gaps >> np.uint64(k)).astype(np.int64)
    unary = np.zeros(int(q.sum()) + n, np.uint8)
    unary[np.cumsum(q + 1) - 1] = 1
    rest = ((gaps[:, None] >> np.arange(k, dtype=np.uint64)[None, ::-1]) & np.uint64(1)).astype(np.uint8)
    coded = np.packbits(unary).tobytes()
    return head + len(coded).to_bytes(4, "little") + coded + np.packbits(rest.ravel()).tobytes()


def golomb_decode(code: bytes) -> np.ndarray:
    n, k = int.from_bytes(code[:4], "little"), code[4]
    if not n:
        return np.zeros(0, np.uint64)
    size = int.from_bytes(code[5:9], "little")
    q = np.diff(np.flatnonzero(np.unpackbits(np.frombuffer(code, np.uint8, size, 9)))[:n], prepend=-1).astype(np.uint64) - np.uint64(1)
    rest = np.unpackbits(np.frombuffer(code, np.uint8, offset=9 + size))[: n * k].reshape(n, k)
    low = np.zeros(n, np.uint64)
    for j in range(k):
        low = (low << np.uint64(1)) | rest[:, j].astype(np.uint64)
    return (q << np.uint64(k)) | low


def _sender(owners: int):
    def send(batches):
        release()
        held, n_packet = [], 0

        def flush():
            nonlocal held, n_packet
            part = (task_id() << 24) + n_packet
            n_packet += 1
            fps = np.array([h[2] for h in held], np.uint64)
            order = np.argsort(fps, kind="stable")
            fp = fps[order]
            start = runs(fp)
            distinct, many = fp[start[:-1]], (np.diff(start) > 1).astype(np.uint8)
            owner = ((distinct * np.uint64(owners)) >> np.uint64(FP_BITS)).astype(np.int64)
            at = runs(owner)
            first = np.repeat(at[:-1], np.diff(at))  # of each fingerprint: where its owner's range begins
            rank = np.arange(len(distinct)) - first
            of = np.repeat(np.arange(len(distinct)), np.diff(start))
            ids = [held[i] for i in order]
            n = len(held)
            light = batch(_ROW, [0] * n, [part] * n, owner[of], rank[of], [h[0] for h in ids], [h[1] for h in ids], fp.astype(np.int64), [None] * n)
            codes = [golomb_encode(np.diff(distinct[a:b], prepend=np.uint64(0))) for a, b in zip(at[:-1], at[1:])]
            codes = [len(c).to_bytes(4, "little") + c + np.packbits(many[a:b]).tobytes() for c, a, b in zip(codes, at[:-1], at[1:])]
            m = len(codes)
            sent = batch(_ROW, [1] * m, [part] * m, owner[at[:-1]], [None] * m, [None] * m, [None] * m, [None] * m, codes)
            held = []
            return light, sent

        for i, raw in rows_of(batches, "id", "text"):
            sha = hashlib.sha256(raw.lower()).digest()
            held.append((i, sha, int.from_bytes(sha[:8], "big") >> (64 - FP_BITS)))
            if len(held) >= PACKET_DOCS:
                yield from flush()
        if held:
            yield from flush()

    return send


def _owned(rows: pa.Table) -> pa.Table:
    """For each sender of an owner's range, the ranks of its fingerprints that occur more than once, as a bitmap."""
    sent = []
    for part, owner, code in zip(*(rows.column(c).to_pylist() for c in ("part", "owner", "payload"))):
        size = int.from_bytes(code[:4], "little")
        fp = np.cumsum(golomb_decode(code[4 : 4 + size]), dtype=np.uint64)
        sent.append((part, owner, fp, np.unpackbits(np.frombuffer(code, np.uint8, offset=4 + size))[: len(fp)]))
    fp, n = np.unique(np.concatenate([s[2] for s in sent]), return_counts=True)
    out = [(part, owner, np.packbits((n[np.searchsorted(fp, own)] > 1) | (many > 0)).tobytes()) for part, owner, own, many in sent]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.binary()))], ["part", "owner", "bitmap"])


def _marked(batches):
    """One row for each set bit."""
    for b in batches:
        part, owner, rank = [], [], []
        for p, o, bits in zip(*(b.column(c).to_pylist() for c in ("part", "owner", "bitmap"))):
            at = np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8)))
            part += [p] * len(at)
            owner += [o] * len(at)
            rank += at.tolist()
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(owner, pa.int32()), pa.array(rank, pa.int64())], ["part", "owner", "rank"])


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, one row per input row.

    Texts are equal when identical after lower-casing A-Z; null counts as
    empty, and all empty texts are equal. Of equal texts the row with the
    largest id stays (a null id is smaller than any); of repeated rows with
    that id exactly one stays. ``text_sha256`` is of the normalised UTF-8
    bytes. An empty table gives no rows; texts are compared whole.
    """
    spark = docs.sparkSession
    owners = partitions(spark)
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    sent = cut_lineage(base.mapInArrow(_sender(owners), _DDL))
    marked = sent.filter("kind = 1").groupBy("owner").applyInArrow(_owned, "part long, owner int, bitmap binary").mapInArrow(_marked, "part long, owner int, rank long")
    light = sent.filter("kind = 0").select("part", "owner", "rank", "doc_id", "sha", "fp").withColumn("row", F.monotonically_increasing_id())
    suspects = cut_lineage(light.join(marked, ["part", "owner", "rank"], "left_semi").select("doc_id", "row", "sha", "fp"))

    # A filter of fixed size over the suspects' fingerprints picks the texts whose bytes are shuffled.
    words = suspects.select(F.expr(f"cast(pmod(fp, {FILTER_BITS}) div 64 as int)").alias("w"), F.expr(f"shiftleft(1L, cast(pmod(fp, {FILTER_BITS}) % 64 as int))").alias("b"))
    words = words.groupBy("w").agg(F.bit_or("b").alias("b")).collect()  # FILTER_BITS / 64 rows at most
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    for w, b in words:
        bits[w] = b
    shared = spark.sparkContext.broadcast(np.unpackbits(bits.view(np.uint8), bitorder="little")) if len(words) else None

    def suspect_texts(batches):
        for b in batches:
            sha, text = [], []
            for raw in byte_texts(b.column("text")):
                raw = raw.lower()
                h = hashlib.sha256(raw).digest()
                if shared.value[(int.from_bytes(h[:8], "big") >> (64 - FP_BITS)) % FILTER_BITS]:
                    sha.append(h)
                    text.append(raw)
            yield pa.RecordBatch.from_arrays([pa.array(sha, pa.binary()), pa.array(text, pa.binary())], ["sha", "bytes"])

    if shared is not None:
        groups = base.select("text").mapInArrow(suspect_texts, "sha binary, bytes binary").groupBy("sha", "bytes").agg(F.count("*").alias("n"))
        groups = groups.groupBy("sha").agg(F.count("*").alias("texts"), F.sum("n").alias("n"))
        groups = groups.select("sha", "n", F.when(F.col("texts") > 1, F.raise_error(F.lit("different texts with one SHA-256"))).otherwise(F.lit(True)).alias("same"))
        best = suspects.groupBy("sha").agg(F.max(F.struct("doc_id", "row")).alias("keep"))
        groups = groups.filter("n > 1 and same").join(best, "sha").select("sha", "n", F.col("keep.doc_id").alias("keep_id"), F.col("keep.row").alias("keep_row"))
        groups = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        light = light.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int"))
        light = light.join(groups, ["sha", "salt"], "left")
    else:
        light = light.select("*", F.lit(None).cast("long").alias("n"), F.lit(None).cast("long").alias("keep_id"), F.lit(None).cast("long").alias("keep_row"))
    return light.select(
        "doc_id",
        F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("row") == F.col("keep_row"), F.lit(True)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
