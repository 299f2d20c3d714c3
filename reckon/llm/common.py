"""Helpers shared by the operators: table access, Arrow plumbing, packets of
numpy arrays, and word blocks.

Operators take a DataFrame, select by name the few columns they need (extra
columns are ignored) and treat a null text as empty.
"""

from __future__ import annotations

import ctypes
import gc
import os
import struct
import sys
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Makes this package importable in Python workers that were started elsewhere
    (what ``--py-files`` does for a submitted job). Once per application."""
    root, sc = Path(__file__).resolve().parents[2], spark.sparkContext
    on_path = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    if sc.applicationId in _SHIPPED or any(p and Path(p).resolve() == root for p in on_path):
        return
    target = Path(tempfile.mkdtemp(prefix="reckon-code-")) / "reckon_code.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted((root / "reckon").rglob("*.py")):
            z.write(f, f.relative_to(root))
    sc.addPyFile(str(target))
    _SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_code(spark)
    # few rows at a time reach the Python workers, as texts can be long
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    """Shuffle partitions of the session: the number of owners that packets are dealt to."""
    return max(4, int(spark.conf.get("spark.sql.shuffle.partitions")))


def held_out(doc_id: Column | str, remainder: int) -> Column:
    """crc32 of the id as text leaves ``remainder`` modulo 5; a null id is never held out."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 5 == remainder, F.lit(False))


def byte_texts(column) -> list[bytes]:
    """UTF-8 bytes of a string column of an Arrow batch, null as empty."""
    c = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return [x or b"" for x in c.cast(pa.binary()).to_pylist()]


def rows_of(batches: Iterator[pa.RecordBatch], *names: str):
    """Rows of Arrow batches, one tuple of Python values each; ``text`` as UTF-8 bytes."""
    for b in batches:
        cols = [byte_texts(b.column(n)) if n == "text" else b.column(n).to_pylist() for n in names]
        yield from zip(*cols)


def by_bytes(rows, most: int = 4_000_000):
    """Lists of (id, text) rows with about ``most`` bytes of text each, or one row."""
    held, size = [], 0
    for row in rows:
        if held and size + len(row[1]) > most:
            yield held
            held, size = [], 0
        held.append(row)
        size += len(row[1]) + 16
    if held:
        yield held


def release(tokens: bool = True) -> None:
    """Frees what the tasks of other stages left in this Python worker, which Spark
    uses again: the token cache (if ``tokens``), and freed memory that the allocators hold."""
    if tokens and (bpe := sys.modules.get("reckon.llm.bpe")):
        bpe.id_cache.cache_clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def task_id() -> int:
    ctx = TaskContext.get()
    return ctx.partitionId() if ctx else 0


# --- packets: named numpy arrays in one compressed binary -----------------

#: One context a process: a compressor is costly to set up for each packet.
_ZIP, _UNZIP = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def pack(*arrays: np.ndarray | bytes) -> bytes:
    """Arrays (stored by byte plane, so that the high bytes of sorted values
    compress away) and byte strings as one compressed packet."""
    out = []
    for a in arrays:
        if isinstance(a, bytes):
            out.append(struct.pack("<cQ", b"S", len(a)) + a)
        else:
            a = np.ascontiguousarray(a)
            planes = a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes() if len(a) else b""
            out.append(struct.pack("<cQ", a.dtype.char.encode(), len(a)) + planes)
    return _ZIP.compress(b"".join(out))


def unpack(packet: bytes) -> list[np.ndarray | bytes]:
    raw, at, out = _UNZIP.decompress(packet), 0, []
    while at < len(raw):
        kind, n = struct.unpack_from("<cQ", raw, at)
        at += 9
        if kind == b"S":
            out.append(raw[at : at + n])
            at += n
        else:
            t = np.dtype(kind.decode())
            planes = np.frombuffer(raw, np.uint8, n * t.itemsize, at).reshape(t.itemsize, n)
            out.append(np.ascontiguousarray(planes.T).reshape(-1).view(t))
            at += n * t.itemsize
    return out


# --- word blocks ----------------------------------------------------------


class Vocab(dict):
    """Numbers keys in the order in which they are first seen."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n

    def ids(self, keys: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, keys), np.int32, len(keys))


#: A block of documents that one task holds at a time ends at so many words or documents.
BLOCK_WORDS, BLOCK_DOCS = 2_500_000, 60_000


def doc_words(doc: np.ndarray, word: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (word, document) pairs, by word, with the number of times."""
    key = word.astype(np.int64) * BLOCK_DOCS + doc
    key, n = np.unique(key, return_counts=True)
    return key // BLOCK_DOCS, (key % BLOCK_DOCS).astype(np.uint16), n.astype(np.uint32)


def runs(sorted_values: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal values, and the end."""
    if not len(sorted_values):
        return np.zeros(1, np.int64)
    return np.concatenate([[0], np.flatnonzero(sorted_values[1:] != sorted_values[:-1]) + 1, [len(sorted_values)]])


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads them evenly."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def taken(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The slices of ``values``, one after the other."""
    upto = np.cumsum(size)
    return values[np.repeat(start - (upto - size), size) + np.arange(upto[-1] if len(upto) else 0)]


class RunHash:
    """64-bit hashes of slices of a byte array that do not overlap: the sum of one pseudorandom value for each byte at each place of the slice."""

    NEAR = 64

    def __init__(self):
        self.near = mix64(np.arange(256 * self.NEAR, dtype=np.uint64) + np.uint64(1))

    def __call__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        if not len(start):
            return np.zeros(0, np.uint64)
        size = end - start
        first = np.cumsum(size) - size
        cell = (np.arange(size.sum()) - np.repeat(first, size)) * 256 + taken(data, start, size)
        if size.max() <= self.NEAR:
            value = self.near[cell]
        else:
            value = self.near[np.minimum(cell, len(self.near) - 1)]
            far = np.flatnonzero(cell >= len(self.near))
            value[far] = mix64(cell[far].astype(np.uint64) + np.uint64(1))
        return mix64(np.add.reduceat(value, first) + size.astype(np.uint64))


#: Bytes that part words: space and 9 to 13.
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def word_hashes(texts: list[bytes], hasher: RunHash) -> list[np.ndarray]:
    """64-bit hashes of the words of each text, in order."""
    data = np.frombuffer(b" ".join(texts), np.uint8)
    edge = np.flatnonzero(np.diff(~_SPACE[data], prepend=False, append=False))
    start, end = edge[::2], edge[1::2]
    cut = np.searchsorted(start, np.cumsum([len(t) + 1 for t in texts]))
    return np.split(hasher(data, start, end), cut[:-1])


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def packets(owner: np.ndarray, *arrays: np.ndarray) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Deals the rows of equally long arrays to their owners, in stable order."""
    order = np.argsort(owner, kind="stable")
    owner, arrays = owner[order], [a[order] for a in arrays]
    at = runs(owner)
    for lo, hi in zip(at[:-1], at[1:]):
        yield int(owner[lo]), [a[lo:hi] for a in arrays]
