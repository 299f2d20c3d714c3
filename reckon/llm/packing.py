"""Packing into windows by Karmarkar-Karp multiway differencing.

Documents are tokenised once, in place; only piece sizes travel. A document
longer than the capacity is cut into full windows and a tail. The pieces are
dealt evenly to blocks of about ``BLOCK_WINDOWS`` windows; within a block the
largest two partial partitions (by spread between their fullest and emptiest
window) are merged, full windows of one onto empty windows of the other,
until one is left. If a window exceeds the capacity the window count rises.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reckon.llm.bpe import CACHED, id_cache
from reckon.llm.common import batch, by_bytes, release, rows_of, runs
from reckon.session import cut_lineage

#: Windows of a block on average, and the bits of a window's number within its block.
BLOCK_WINDOWS, WINDOW_BITS = 1024, 24

_PIECE = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())])


def difference(sizes: np.ndarray, k: int) -> np.ndarray:
    """The window (0..k-1) of each size, by multiway differencing.

    A partial partition holds the sums of its used windows in descending
    order and the items of each; unused windows are empty. Windows hold
    linked lists of items, so that joining two costs nothing."""
    n = len(sizes)
    if k <= 1 or n == 0:
        return np.zeros(n, np.int64)
    order = np.argsort(-sizes, kind="stable")
    next_, tail = np.full(n, -1, np.int64), np.arange(n)  # linked lists; a window is named by its first item
    heap = [(-int(sizes[i]), r, np.array([sizes[i]], np.int64), np.array([i])) for r, i in enumerate(order)]
    heapq.heapify(heap)
    made = n
    while len(heap) > 1:
        _, _, s1, i1 = heapq.heappop(heap)
        _, _, s2, i2 = heapq.heappop(heap)
        over = len(s1) + len(s2) - k
        if over <= 0:
            sums, items = np.concatenate([s1, s2]), np.concatenate([i1, i2])
        else:
            # the `over` emptiest used windows of one take the fullest of the other in reverse, as it has too few empty ones
            low, top = slice(len(s1) - over, len(s1)), slice(len(s2) - over, len(s2))
            a, b = i1[low], i2[top][::-1]
            next_[tail[a]], tail[a] = b, tail[b]
            sums = np.concatenate([s1[: low.start], s2[: top.start], s1[low] + s2[top][::-1]])
            items = np.concatenate([i1[: low.start], i2[: top.start], a])
        by = np.argsort(-sums, kind="stable")
        sums, items = sums[by], items[by]
        if len(sums) == k:
            base = int(sums[-1])
            spread = int(sums[0]) - base
        else:
            spread = int(sums[0])
        heapq.heappush(heap, (-spread, made, sums, items))
        made += 1
    window = np.empty(n, np.int64)
    for w, i in enumerate(heap[0][3]):
        while i >= 0:
            window[i] = w
            i = next_[i]
    return window


def pack_block(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Windows of pieces no larger than the capacity; pieces of that size fill one each."""
    full = sizes >= capacity
    window = np.empty(len(sizes), np.int64)
    window[full] = np.arange(full.sum())
    rest = sizes[~full]
    if len(rest):
        total, k = int(rest.sum()), -(-int(rest.sum()) // capacity)
        while True:
            got = difference(rest, k)
            most = int(np.bincount(got, rest, k).max())
            if most <= capacity:
                break
            k = max(k + 1, -(-total // max(1, capacity - (most - total // k))))
        window[~full] = got + full.sum()
    return window


def pieces(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int, id_col: str = "doc_id", text_col: str = "text", at_once: int = 4_000_000, cached: tuple[int, int] = CACHED) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens: the pieces of each document, cut at multiples
    of the capacity. A task tokenises about ``at_once`` bytes of text at a
    time and keeps the ids of ``cached`` runs and pre-tokens."""

    def cut(batches: Iterator[pa.RecordBatch]):
        release(tokens=False)
        cache, end, out = id_cache(tokenizer_path, cached), np.array([end_id], "<u4"), []
        for rows in by_bytes(rows_of(batches, "id", "text"), at_once):
            for (i, _), ids in zip(rows, cache.encode([raw.decode("utf-8", "replace") for _, raw in rows])):
                ids = np.append(ids, end)
                for at in range(0, len(ids), capacity):
                    own = ids[at : at + capacity]
                    out.append((i, at, len(own), zlib.crc32(own), len(ids)))
            if len(out) > 20_000:
                yield batch(_PIECE, *zip(*out))
                out = []
        if out:
            yield batch(_PIECE, *zip(*out))

    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return base.mapInArrow(cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 2, capacity: int = 4096, id_col: str = "doc_id", text_col: str = "text", at_once: int = 4_000_000, cached: tuple[int, int] = CACHED) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset: one row per piece.

    A null or empty text is one piece with the end id alone. Null ids and
    repeated rows are packed like any others. Pieces in a window lie gapless
    from 0, ordered by their number in the block. An empty table gives no rows.
    """
    cut = cut_lineage(pieces(docs, tokenizer_path, end_id, capacity, id_col, text_col, at_once, cached))
    total = cut.agg(F.sum("length")).first()[0] or 0
    blocks = max(1, round(total / (capacity * BLOCK_WINDOWS)))

    def packed(own: pa.Table) -> pa.Table:
        release()  # the token cache, no longer needed
        own = own.sort_by([("doc_id", "ascending"), ("start", "ascending"), ("row", "ascending")])
        length = own.column("length").to_numpy()
        window = pack_block(length, capacity)
        by = np.argsort(window, kind="stable")
        own, length, window = own.take(pa.array(by)), length[by], window[by]
        at = runs(window)
        before = np.cumsum(length) - length
        offset = before - np.repeat(before[at[:-1]], np.diff(at))
        block = own.column("block").to_numpy()
        out = own.select(_PIECE.names)
        return out.append_column("sequence_id", pa.array((block << WINDOW_BITS) + window, pa.int64())).append_column("offset", pa.array(offset, pa.int64()))

    # The rows' numbers are stable: they come from written files.
    cut = cut.withColumn("row", F.monotonically_increasing_id()).withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
    return cut.groupBy("block").applyInArrow(packed, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
