"""Language-model scores from a sharded Elias-Fano n-gram trie.

Every word is a 64-bit hash. 1. The distinct words of each block of documents
go to the owners of their hashes, which return the training counts. 2. The
blocks, with counts, send their distinct bigrams (context, word) and the
documents that hold them to the owners of the contexts; contexts that are very
frequent are dealt by context and word. 3. Each owner builds its shard of the
trie from the training documents: sorted contexts, monotone pointers to their
successors, the successors relative to their context, all Elias-Fano coded and
memory-mapped, and quantised log-probabilities. All its bigrams are then looked
up by successor search within the context's range. 4. Sums return to the blocks.

p(word | context) = (c(context word) + MU p(word)) / (c(context) + MU), with
p(word) the smoothed unigram share; the model grows with the input.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reckon.llm.common import RunHash, batch, by_bytes, pack, partitions, rows_of, runs, task_id, unpack, word_hashes
from reckon.llm.elias_fano import EliasFano
from reckon.session import cut_lineage

#: Hashes that stand for a document's start and end; weight of the unigram share; bits of a
#: successor's hash; levels of a log-probability (in steps of 12 / LEVELS, from 0 to -12).
START, END, MU, WORD_BITS, LEVELS = np.uint64(1), np.uint64(2), 2.0, 40, 65535
BLOCK_WORDS, BLOCK_DOCS = 1_200_000, 30_000
HELD_REMAINDER = 1

_ROW = pa.schema([("owner", pa.int32()), ("block", pa.int64()), ("payload", pa.binary()), ("n", pa.int64()), ("v", pa.int64())])
_DDL = "owner int, block long, payload binary, n long, v long"


def _row(owner: int, block: int, payload: bytes | None, n: int | None = None, v: int | None = None) -> pa.RecordBatch:
    return batch(_ROW, [owner], [block], [payload], [n], [v])


def _blocks(batches):
    """(block, ids, held out, lengths, distinct hashes, their places in the token stream). An end closes each text."""
    hasher, n_block, ids, words, held = RunHash(), 0, [], [], 0

    def flush():
        length = np.array([len(w) for w in words], np.int64)
        distinct, place = np.unique(np.concatenate(words), return_inverse=True)
        out = [i is not None and zlib.crc32(str(i).encode()) % 5 == HELD_REMAINDER for i in ids]
        return (task_id() << 24) + n_block, ids, np.array(out, bool), length, distinct, place.astype(np.int32)

    for rows in by_bytes(rows_of(batches, "id", "text"), 1_000_000):
        for (i, _), w in zip(rows, word_hashes([raw.lower() for _, raw in rows], hasher)):
            ids.append(i)
            words.append(np.append(w, END))
            held += len(w) + 1
            if held >= BLOCK_WORDS or len(ids) >= BLOCK_DOCS:
                yield flush()
                n_block, ids, words, held = n_block + 1, [], [], 0
    if ids:
        yield flush()


def _owner(hashes: np.ndarray, owners: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(owners) >> np.uint64(32)).astype(np.int64)


def _counts(owners: int):
    """To the owners: the words of a block with their training counts there."""

    def counts(batches):
        for block, _, out, length, distinct, place in _blocks(batches):
            seen = np.bincount(place[np.repeat(~out, length)], minlength=len(distinct)).astype(np.uint32)
            owner = _owner(distinct, owners)
            at = runs(owner)
            for lo, hi in zip(at[:-1], at[1:]):
                yield _row(int(owner[lo]), block, pack(distinct[lo:hi], seen[lo:hi]))

    return counts


def _summed(rows: pa.Table) -> pa.Table:
    """Back to the blocks: counts over all blocks, in the order sent; and the owner's tokens and distinct training words."""
    parts = [unpack(p) for p in rows.column("payload").to_pylist()]
    word, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    total = np.bincount(at, np.concatenate([p[1] for p in parts]), len(word)).astype(np.uint64)
    owner, out, lo = rows.column("owner")[0].as_py(), [], 0
    for block, p in zip(rows.column("block").to_pylist(), parts):
        out.append(_row(owner, block, pack(total[at[lo : lo + len(p[0])]])))
        lo += len(p[0])
    out.append(_row(-1, -1, None, int(total.sum()), int((total > 0).sum())))
    return pa.Table.from_batches(out)


def _streams(batches):
    for block, ids, out, length, distinct, place in _blocks(batches):
        yield _row(-1, block, pack(np.array([i or 0 for i in ids], np.int64), np.array([i is None for i in ids], np.uint8), out.astype(np.uint8), length, distinct, place))


def _bigrams(owners: int, n: int, v: int, n_docs: int):
    """Of a block: its documents' base scores (to any owner, which hands them on), and its bigrams to their owners."""
    floor = np.log10(n + 0.5 * (v + 1))

    def bigrams(rows: pa.Table) -> pa.Table:
        parts = sorted(zip(rows.column("owner").to_pylist(), rows.column("payload").to_pylist()), key=lambda x: x[0])
        block = rows.column("block")[0].as_py()
        ids, no_id, held, length, distinct, place = unpack(parts[0][1])
        count = np.concatenate([unpack(p)[0] for _, p in parts[1:]])
        doc = np.repeat(np.arange(len(ids)), length)
        base = np.bincount(doc, np.log10(count + 0.5)[place], len(ids)) - length * floor
        known = np.bincount(doc, (count > 0)[place], len(ids)).astype(np.int64)
        out = [_row(block % owners, block, pack(b"docs", ids, no_id, held, length, known, base))]
        # a context is the word before, or the start
        first = np.cumsum(length) - length
        before = np.empty(len(place), np.int64)
        before[1:] = place[:-1]
        before[first] = len(distinct)
        context, of = np.append(distinct, START), np.append(count, n_docs).astype(np.int64)
        owner = _owner(context, owners)[before]
        hot = (of > n / (4 * owners))[before]
        owner[hot] = _owner((context[before[hot]] * np.uint64(0x9E3779B97F4A7C15)) ^ distinct[place[hot]], owners)
        order = np.lexsort((place, before, owner))
        owner, before, place, doc = owner[order], before[order], place[order], doc[order].astype(np.uint16)
        doc |= np.where(held[doc] > 0, 0, 1 << 15).astype(np.uint16)  # the top bit: a training document
        at = runs(owner)
        for lo, hi in zip(at[:-1], at[1:]):
            pair = runs(before[lo:hi].astype(np.int64) * (len(distinct) + 1) + place[lo:hi]) + lo
            b, p = before[pair[:-1]], place[pair[:-1]]
            ctx = runs(b)
            c = b[ctx[:-1]]
            out.append(_row(int(owner[lo]), block, pack(b"pairs", context[c], of[c].astype(np.uint64), np.diff(ctx).astype(np.uint32), distinct[p] >> np.uint64(64 - WORD_BITS), count[p], np.diff(pair).astype(np.uint32), doc[lo:hi])))
        return pa.Table.from_batches(out)

    return bigrams


class Trie:
    """Contexts and their successors with quantised log-probabilities. Places are of the sorted contexts."""

    def __init__(self, context: np.ndarray, word: np.ndarray, log_p: np.ndarray):
        """Distinct (context, word) pairs, sorted."""
        at = runs(context)
        self.contexts = EliasFano(context[at[:-1]], 1 << 64)
        self.pointers = EliasFano(at, len(context) + 1)
        rank = np.repeat(np.arange(len(at) - 1, dtype=np.uint64), np.diff(at))
        # relative to its context: the context's rank keeps the level monotone
        self.words = EliasFano((rank << np.uint64(WORD_BITS)) | word, max(1, len(at) - 1) << WORD_BITS)
        self.code = np.round(np.clip(-log_p / 12, 0, 1) * LEVELS).astype(np.uint16)

    def log_p(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """log10 p of pairs in the trie, NaN for others."""
        k = self.contexts.find(context)
        out = np.full(len(k), np.nan)
        there = np.flatnonzero(k >= 0)
        at = self.words.find((k[there].astype(np.uint64) << np.uint64(WORD_BITS)) | word[there])
        inside = (at >= 0) & (at >= self.pointers.get(k[there]).astype(np.int64)) & (at < self.pointers.get(k[there] + 1).astype(np.int64))
        out[there[inside]] = self.code[at[inside]] * (-12 / LEVELS)
        return out


def _scored(n: int, v: int):
    total = n + 0.5 * (v + 1)

    def scored(rows: pa.Table) -> pa.Table:
        out, got = [], []
        for block, payload in zip(rows.column("block").to_pylist(), rows.column("payload").to_pylist()):
            part = unpack(payload)
            if part[0] == b"docs":
                out.append(_row(-1, block, payload))
            else:
                got.append((block, *part[1:]))
        if not got:
            return pa.Table.from_batches(out, _ROW)
        join = lambda k: np.concatenate([g[k] for g in got])
        context, of = np.repeat(join(1), join(3)), np.repeat(join(2), join(3)).astype(np.float64)
        word, uni, times, doc = join(4), (join(5) + 0.5) / total, join(6).astype(np.int64), join(7)
        taught = np.add.reduceat((doc >> 15).astype(np.int64), np.cumsum(times) - times)
        order = np.lexsort((word, context))
        c, w = context[order], word[order]
        new = np.ones(len(order), bool)
        new[1:] = (c[1:] != c[:-1]) | (w[1:] != w[:-1])
        first = np.flatnonzero(new)
        seen = np.add.reduceat(taught[order], first)
        pair, taught_ = first, seen > 0  # all distinct pairs; those of the trie
        first, seen = first[taught_], seen[taught_]
        lift = of + MU
        trie = Trie(c[first], w[first], np.log10((seen + MU * uni[order[first]]) / lift[order[first]])) if len(first) else None
        log_p = np.log10(MU * uni / lift)  # not in the trie: the context's weight for the unigram share
        if trie is not None:
            found = np.empty(len(order))
            found[order] = np.repeat(trie.log_p(c[pair], w[pair]), np.diff(np.append(pair, len(order))))
            log_p = np.where(np.isnan(found), log_p, found)
        each, lo = np.repeat(log_p, times), 0
        for g in got:
            d = g[7] & 0x7FFF
            s = np.bincount(d, each[lo : lo + len(d)])
            lo += len(d)
            who = np.flatnonzero(np.bincount(d))
            out.append(_row(-2, g[0], pack(b"sums", who.astype(np.uint16), s[who])))
        return pa.Table.from_batches(out, _ROW)

    return scored


def _joined(rows: pa.Table) -> pa.Table:
    parts = [unpack(p) for p in rows.column("payload").to_pylist()]
    _, ids, no_id, held, length, known, base = next(p for p in parts if p[0] == b"docs")
    score = np.zeros(len(ids))
    for p in parts:
        if p[0] == b"sums":
            score[p[1]] += p[2]
    return pa.Table.from_arrays([pa.array(ids, mask=no_id.astype(bool)), pa.array(held.astype(bool)), pa.array(length), pa.array(known), pa.array(base), pa.array(score)], ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, one row per input row.

    Tokens are words between ASCII white space, A-Z lower-cased, and one end. A
    null text counts as empty: the end alone. Rows with crc32(id) mod 5 = 1 are
    held out; a null id is not. Repeated rows all count and are all scored; an
    empty table gives no rows. Scores are log10; the model's probabilities are
    rounded to 12 / 65535.
    """
    spark = docs.sparkSession
    owners = 2 * partitions(spark)
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    back = cut_lineage(base.mapInArrow(_counts(owners), _DDL).groupBy("owner").applyInArrow(_summed, _DDL))
    n, v = back.filter("owner < 0").agg(F.sum("n"), F.sum("v")).first()
    n, v = n or 0, v or 0
    n_docs = base.filter(f"id is null or crc32(cast(cast(id as string) as binary)) % 5 != {HELD_REMAINDER}").count()
    blocks = base.mapInArrow(_streams, _DDL).unionByName(back.filter("owner >= 0"))
    sent = blocks.groupBy("block").applyInArrow(_bigrams(owners, n, v, n_docs), _DDL)
    done = sent.groupBy("owner").applyInArrow(_scored(n, v), _DDL)
    out = done.groupBy("block").applyInArrow(_joined, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")
