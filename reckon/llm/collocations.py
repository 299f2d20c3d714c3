"""Collocations: frequent phrases of 2 to 5 words that hold together at every cut.

Frequent words get ids by frequency, the most frequent first. Blocks of
documents send their distinct words in one packet a bucket, dealt by a hash of
the word; each bucket is counted whole, and its frequent words return to the
packets that have them. Pairs of neighbouring ids are counted in tiles of the id plane: a tile of two frequent
ranks is a dense array that ``numpy.bincount`` addresses directly, all other
tiles are sorted coordinate lists. The frequent pairs are ranked again and take
the place of the words, so that a neighbouring pair of pairs is a phrase of
three words, and so on: a phrase of L words is the pair of its first and its
last L - 1. Nothing but frequent phrases can be part of a frequent phrase, so
no candidate is lost.

Blocks of documents keep their sequence of ids and send each tile one packet of
distinct pairs; a tile's packets are added up in a tree of at most ``FAN`` a
group, so that the tile of the most frequent pairs is no hot group. The ids of
the frequent pairs return to the blocks by the same tiles.
"""

from __future__ import annotations

import json
import re
from collections import defaultdict
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reckon.llm import common
from reckon.llm.common import Vocab, batch, packets, partitions, release, rows_of, runs, task_id
from reckon.session import cut_lineage

#: Words of a block, ids along a tile's edge, dense tiles along the plane's edge, entries of a
#: packet, packets that one task adds up, and coordinate entries that it holds before it adds them.
BLOCK, EDGE, DENSE, PACKET, FAN, HELD = 2_500_000, 1024, 16, 1 << 16, 256, 1 << 21
#: Buckets of words for each shuffle partition: a task counts one bucket at a time.
BUCKETS = 4
#: A pair of ids as one number.
BITS = 31
MASK = (1 << BITS) - 1

#: What parts pieces, and words within them.
_TOKEN = re.compile(rb"[.,;:!?\n-\r]|[^ \t.,;:!?\n-\r]+")
PIECE_ENDS = [bytes([c]) for c in b".,;:!?\n\x0b\x0c\r"]


# --- packets ----------------------------------------------------------------


def _fewest(a: np.ndarray) -> np.ndarray:
    return a.astype(np.min_scalar_type(int(a.max(initial=0))))


def pack(*arrays: np.ndarray | bytes) -> bytes:
    """Numbers from -1 on and byte strings as one packet, in the fewest bytes: ascending numbers
    as pairs, by the steps of the left and, for the same left, of the right; others by one more."""
    out = []
    for a in arrays:
        if isinstance(a, bytes):
            out += [b"bytes", a]
            continue
        a = a.astype(np.int64)
        if len(a) and a[0] >= 0 and (a[1:] >= a[:-1]).all():
            left, right = np.diff(a >> BITS, prepend=0), a & MASK
            right[1:] -= np.where(left[1:] == 0, right[:-1], 0)
            out += [b"steps", _fewest(left), _fewest(right)]
        else:
            out += [b"values", _fewest(a + 1)]
    return common.pack(*out)


def unpack(packet: bytes) -> list[np.ndarray | bytes]:
    out, parts = [], iter(common.unpack(packet))
    for kind in parts:
        a = next(parts)
        if kind == b"values":
            a = a.astype(np.int64) - 1
        elif kind == b"steps":
            left, right = a.astype(np.int64), next(parts).astype(np.int64)
            upto, first = np.cumsum(right), np.flatnonzero(left)  # the sum starts again where the left is another
            before = np.concatenate([[0], upto[first] - right[first]])
            a = (np.cumsum(left) << BITS) | (upto - before[np.cumsum(left > 0)])
        out.append(a)
    return out


# --- tiles ------------------------------------------------------------------


def tile_of(code: np.ndarray, owners: int) -> np.ndarray:
    """Tiles of pairs: below DENSE * DENSE one dense tile each, from there on sparse tiles, dealt to ``owners``."""
    i, j = code >> BITS, code & MASK
    i //= EDGE
    j //= EDGE
    dense = np.flatnonzero((i < DENSE) & (j < DENSE))
    near = i[dense] * DENSE + j[dense]
    i *= 40503
    j *= 10007
    i += j
    i %= owners
    tile = (i + DENSE * DENSE).astype(np.int32)
    tile[dense] = near
    return tile


def cells(code: np.ndarray) -> np.ndarray:
    """Places of a dense tile's pairs in its array."""
    return (code >> BITS) % EDGE * EDGE + (code & MASK) % EDGE


def from_cells(tile: int, cell: np.ndarray) -> np.ndarray:
    return ((tile // DENSE * EDGE + cell // EDGE) << BITS) | (tile % DENSE * EDGE + cell % EDGE)


def count_pairs(code: np.ndarray, owners: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(tile, sorted pairs, counts): dense tiles with many pairs by direct address, others sorted."""
    for tile, (own,) in packets(tile_of(code, owners), code):
        if tile < DENSE * DENSE and len(own) >= EDGE * EDGE // 16:
            n = np.bincount(cells(own), minlength=EDGE * EDGE)
            cell = np.flatnonzero(n)
            yield tile, from_cells(tile, cell), n[cell]
        else:
            yield tile, *np.unique(own, return_counts=True)


class Tile:
    """Adds up the packets of a tile."""

    def __init__(self, tile: int):
        self.tile, self.dense = tile, np.zeros(EDGE * EDGE, np.int64) if tile < DENSE * DENSE else None
        self.code, self.n, self.size = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0

    def add(self, code: np.ndarray, n: np.ndarray) -> None:
        if self.dense is not None:
            self.dense[cells(code)] += n  # a packet has a pair once
            return
        self.code.append(code)
        self.n.append(n)
        self.size += len(code)
        if self.size > HELD + 2 * len(self.code[0]):
            self.total()

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted pairs and their sums."""
        if self.dense is not None:
            cell = np.flatnonzero(self.dense)
            return from_cells(self.tile, cell), self.dense[cell]
        code, n = np.concatenate(self.code), np.concatenate(self.n)
        order = np.argsort(code, kind="stable")
        code, n = code[order], n[order]
        at = runs(code)[:-1]
        code, n = code[at], np.add.reduceat(n, at) if len(at) else n
        self.code, self.n, self.size = [code], [n], len(code)
        return code, n


_PACKET = pa.schema([("tile", pa.int64()), ("block", pa.int64()), ("payload", pa.binary())])
_PACKET_DDL = "tile long, block long, payload binary"


def _packed(tile: int, block: int, first: np.ndarray, second: np.ndarray) -> Iterator[tuple]:
    for k in range(0, len(first), PACKET):
        yield tile, block, pack(first[k : k + PACKET], second[k : k + PACKET])


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[Tile]:
    """Sums of the tiles of a stream of packets that is sorted by tile."""
    now = None
    for b in batches:
        for tile, payload in zip(b.column("tile").to_pylist(), b.column("payload").to_pylist()):
            if now is not None and now.tile != tile:
                yield now
                now = None
            now = now or Tile(tile)
            now.add(*unpack(payload))
    if now is not None:
        yield now


def _added(batches: Iterator[pa.RecordBatch]):
    release()
    for t in _tiles(batches):
        for row in _packed(t.tile, task_id(), *t.total()):
            yield batch(_PACKET, *([x] for x in row))


def pair_counts(sent: DataFrame, blocks: int, least: int) -> DataFrame:
    """code, f: the pairs that occur ``least`` times or more, from packets (tile, block, payload) of ``blocks`` blocks."""
    n, salts = partitions(sent.sparkSession), -(-blocks // FAN)
    while salts > 1:
        salted = sent.withColumn("salt", F.pmod(F.xxhash64("block"), F.lit(salts)))
        sent = salted.repartition(n, "tile", "salt").sortWithinPartitions("tile", "salt").select("tile", "block", "payload").mapInArrow(_added, _PACKET_DDL)
        salts = salts // FAN

    def frequent(batches):
        release()
        for t in _tiles(batches):
            code, f = t.total()
            keep = f >= least
            yield pa.RecordBatch.from_arrays([pa.array(code[keep]), pa.array(f[keep])], ["code", "f"])

    return sent.repartition(n, "tile").sortWithinPartitions("tile").mapInArrow(frequent, "code long, f long")


# --- ranks and the way back ---------------------------------------------------


def ranked(rows: DataFrame, *order: Column) -> DataFrame:
    """A written table of ``rows`` with id, from 0 in ``order``: positions within the sorted partitions, after all partitions before."""
    placed = cut_lineage(rows.orderBy(*order).withColumn("id", F.monotonically_increasing_id()))
    part = F.shiftright("id", 33)
    held = {r.part: r.n for r in placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}  # one row a shuffle partition
    starts = rows.sparkSession.createDataFrame(_starts(held), "part long, start long")
    return placed.withColumn("part", part).join(starts, "part").withColumn("id", F.col("start") + F.col("id") - F.shiftleft("part", 33)).drop("part", "start")


def _starts(held: dict[int, int]) -> list[tuple[int, int]]:
    part = sorted(held)
    return list(zip(part, [0, *np.cumsum([held[p] for p in part[:-1]]).tolist()]))


_BACK = pa.schema([("block", pa.int64()), ("payload", pa.binary())])


def pair_ids(sent: DataFrame, phrases: DataFrame, owners: int, blocks: int) -> DataFrame:
    """block, payload: for each packet the ids of its pairs among ``phrases`` (id, code)."""
    salts = max(1, blocks // FAN)

    def dealt(batches):
        for b in batches:
            code, ids = b.column("code").to_numpy(), b.column("id").to_numpy()
            rows = [r for tile, own in packets(tile_of(code, owners), code, ids) for r in _packed(tile, -1, *own)]
            if rows:
                yield batch(_PACKET, *zip(*rows))

    def found(batches):
        release()
        now, known, new = None, (np.zeros(0, np.int64), np.zeros(0, np.int64)), []
        for b in batches:
            out = []
            for tile, salt, block, payload in zip(*(b.column(c).to_pylist() for c in ("tile", "salt", "block", "payload"))):
                if now != (tile, salt):
                    now, known, new = (tile, salt), (np.zeros(0, np.int64), np.zeros(0, np.int64)), []
                if block < 0:  # phrases come before packets
                    new.append(unpack(payload))
                    continue
                if new:
                    code, ids = map(np.concatenate, zip(*new))
                    order = np.argsort(code)
                    known, new = (code[order], ids[order]), []
                code, ids = _known(unpack(payload)[0], *known)
                if len(code):
                    out.append((block, pack(code, ids)))
            if out:
                yield batch(_BACK, *zip(*out))

    known = phrases.select("code", "id").mapInArrow(dealt, _PACKET_DDL).withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    asked = sent.withColumn("salt", F.pmod(F.xxhash64("block"), F.lit(salts).cast("long"))).select("tile", "block", "payload", "salt")
    both = known.union(asked).repartition(partitions(sent.sparkSession), "tile", "salt").sortWithinPartitions("tile", "salt", F.col("block") >= 0)
    return both.mapInArrow(found, "block long, payload binary")


def _known(code: np.ndarray, of: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Those of ``code`` that are in the sorted array ``of``, and their ids."""
    if not len(of):
        return code[:0], ids[:0]
    at = np.minimum(np.searchsorted(of, code), len(of) - 1)
    met = of[at] == code
    return code[met], ids[at[met]]


# --- sequences ----------------------------------------------------------------

_ROW = pa.schema([("kind", pa.int32()), ("tile", pa.int64()), ("block", pa.int64()), ("payload", pa.binary())])
_ROW_DDL = "kind int, tile long, block long, payload binary"
_WORD = pa.schema([("block", pa.int64()), ("lang", pa.string()), ("word", pa.binary()), ("local", pa.int32()), ("n", pa.int64()), ("payload", pa.binary())])


def _words(batches: Iterator[pa.RecordBatch]):
    """Rows of the distinct (lang, word) of each block, and one with its sequence: a number for each word, -1 between pieces and texts."""
    release()
    n_block, seq, size, vocab = 0, [], 0, defaultdict(Vocab)

    def flush():
        flat = np.concatenate(seq)
        base, block = 0, (task_id() << 24) + n_block
        of = np.concatenate(langs)
        for k, (lang, words) in enumerate(vocab.items()):
            own = (of == k) & (flat >= 0)
            n = np.bincount(flat[own], minlength=len(words))[len(PIECE_ENDS) :]
            flat[own] += base - len(PIECE_ENDS)
            flat[own & (flat < base)] = -1
            m = len(n)
            yield batch(_WORD, [block] * m, [lang] * m, list(words)[len(PIECE_ENDS) :], range(base, base + m), n, [None] * m)
            base += m
        yield batch(_WORD, [block], [None], [None], [None], [None], [pack(flat)])

    langs: list[np.ndarray] = []
    for lang, raw in rows_of(batches, "lang", "text"):
        words = _TOKEN.findall(raw.lower())
        if not words:
            continue
        own = vocab[lang]
        if not own:
            own.ids(PIECE_ENDS)  # the first numbers of every language
        seq += [own.ids(words), np.array([-1], np.int32)]
        langs.append(np.full(len(words) + 1, list(vocab).index(lang), np.int32))
        size += len(words)
        if size >= BLOCK:
            yield from flush()
            n_block, size = n_block + 1, 0
            seq.clear(), langs.clear(), vocab.clear()
    if seq:
        yield from flush()


_DEALT = pa.schema([("kind", pa.int32()), ("bucket", pa.int64()), ("block", pa.int64()), ("lang", pa.string()), ("n", pa.int64()), ("payload", pa.binary())])
_DEALT_DDL = "kind int, bucket long, block long, lang string, n long, payload binary"


def _dealt(buckets: int):
    """A block's sequence (kind 0), its words by bucket (1) and the number of words of each language (2)."""

    def dealt(batches):
        held = []
        for b in _words(batches):
            if len(b) and b.column("payload").null_count == 0:
                if held:
                    yield _vocabulary(b.column("block")[0].as_py(), held, *unpack(b.column("payload")[0].as_py()), buckets)
                held = []
            elif len(b):
                held.append(b)

    return dealt


def _vocabulary(block: int, held: list[pa.RecordBatch], seq: np.ndarray, buckets: int) -> pa.RecordBatch:
    """The words of a block numbered again by count, bucket, language and word: frequent ones have small
    numbers, and the n-th of a bucket's packet is the n-th number that is of the bucket."""
    names, n = [b.column("lang")[0].as_py() for b in held], np.concatenate([b.column("n").to_numpy() for b in held])
    words, lang = pa.concat_arrays([b.column("word") for b in held]), np.repeat(np.arange(len(held)), [len(b) for b in held])
    bucket = np.fromiter(map(crc32, words.to_pylist()), np.int64, len(words)) % buckets
    place = np.empty(len(words), np.int64)
    place[pc.array_sort_indices(words).to_numpy()] = np.arange(len(words))
    order = np.lexsort((place, lang, bucket, -n))
    to = np.full(len(words) + 1, -1, np.int64)  # the last stays for -1
    to[order] = np.arange(len(words))
    rows = [(0, -1, block, None, None, pack(to[seq], bucket[order]))]
    for k, (own,) in packets(bucket[order], order):
        met, of = np.unique(lang[own], return_inverse=True)
        texts = words.take(pa.array(own)).to_pylist()
        rows.append((1, k, block, None, None, pack(b"".join(texts), np.fromiter(map(len, texts), np.int64, len(own)), of, n[own], json.dumps([names[x] for x in met]).encode())))
    rows += [(2, -1, block, name, int(n[lang == k].sum()), None) for k, name in enumerate(names)]
    return batch(_DEALT, *zip(*rows))


_HELD = pa.schema([("bucket", pa.int64()), ("num", pa.int64()), ("block", pa.int64()), ("lang", pa.string()), ("word", pa.binary()), ("f", pa.int64()), ("payload", pa.binary())])
_HELD_DDL = "bucket long, num long, block long, lang string, word binary, f long, payload binary"


def _frequent_words(least: int):
    """From packets sorted by bucket: rows of the words that occur ``least`` times or more, numbered
    within their bucket, and for each packet that has some their places in it and their numbers."""

    def frequent(batches):
        release()
        now, held = None, []
        for b in batches:
            for bucket, block, payload in zip(*(b.column(c).to_pylist() for c in ("bucket", "block", "payload"))):
                if held and bucket != now:
                    yield from _bucket(now, held, least)
                    held = []
                now = bucket
                held.append((block, payload))
        if held:
            yield from _bucket(now, held, least)

    return frequent


def _bucket(bucket: int, held: list[tuple[int, bytes]], least: int) -> Iterator[pa.RecordBatch]:
    langs, texts, sizes, of, counts = Vocab(), [], [], [], []
    for _, payload in held:
        text, size, lang, n, names = unpack(payload)
        texts.append(text), sizes.append(size), counts.append(n)
        of.append(langs.ids(json.loads(names))[lang])
    ends = np.cumsum(np.concatenate([[0], *sizes]))
    words = pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(b"".join(texts))]).dictionary_encode()
    key, at = np.unique(np.concatenate(of).astype(np.int64) * len(words.dictionary) + words.indices.to_numpy(), return_inverse=True)
    f = np.zeros(len(key), np.int64)
    np.add.at(f, at, np.concatenate(counts))
    keep = np.flatnonzero(f >= least)
    m, names = len(keep), list(langs)
    if not m:
        return
    word = words.dictionary.take(pa.array(key[keep] % len(words.dictionary))).to_pylist()
    yield batch(_HELD, [bucket] * m, range(m), [None] * m, [names[k] for k in key[keep] // len(words.dictionary)], word, f[keep], [None] * m)
    num = np.full(len(key), -1, np.int64)
    num[keep] = np.arange(m)
    rows = []
    for (block, _), own in zip(held, np.split(num[at], np.cumsum([len(x) for x in sizes])[:-1])):
        met = np.flatnonzero(own >= 0)
        if len(met):
            rows.append((bucket, None, block, None, None, None, pack(met, own[met])))
    yield batch(_HELD, *zip(*rows))


_ID = pa.schema([("of", pa.int64()), ("bucket", pa.int64()), ("payload", pa.binary())])
_ID_DDL = "of long, bucket long, payload binary"


def _word_ids(sent: pa.Table, known: pa.Table) -> pa.Table:
    """A bucket's packets with ids in place of the numbers within the bucket."""
    ids = np.zeros(len(known), np.int64)
    ids[known.column("num").to_numpy()] = known.column("id").to_numpy()
    payloads = [pack(met, ids[num]) for met, num in map(unpack, sent.column("payload").to_pylist())]
    return pa.table([sent.column("block").combine_chunks(), sent.column("bucket").combine_chunks(), pa.array(payloads, pa.binary())], schema=_ID)


def _next(block: int, seq: np.ndarray, owners: int) -> pa.Table:
    """The rows of a sequence: itself, without ids that have no neighbour, and its pairs by tile."""
    some = seq >= 0
    paired = np.zeros(len(seq) + 2, bool)
    paired[1:-1] = some
    keep = some & (paired[:-2] | paired[2:])
    gap = ~keep & np.concatenate([[False], keep[:-1]])  # one -1 after each run
    seq = np.where(keep, seq, -1)[keep | gap]
    left, right = seq[:-1], seq[1:]
    both = (left >= 0) & (right >= 0)
    if not both.any():
        return pa.Table.from_batches([], _ROW)
    code = (left[both] << BITS) | right[both]
    rows = [(0, -1, block, pack(seq))]
    rows += [(1, *r) for tile, own, n in count_pairs(code, owners) for r in _packed(tile, block, own, n)]
    return pa.table(list(map(pa.array, zip(*rows), _ROW.types)), schema=_ROW)


def _numbered(owners: int):
    """A block's words by their ids."""

    def numbered(own: pa.Table, known: pa.Table) -> pa.Table:
        seq, bucket = unpack(own.column("payload")[0].as_py())
        order = np.argsort(bucket, kind="stable")
        start = dict(zip(*np.unique(bucket[order], return_index=True)))
        to = np.full(len(bucket) + 1, -1, np.int64)  # the last stays for -1
        for k, payload in zip(known.column("bucket").to_pylist(), known.column("payload").to_pylist()):
            place, ids = unpack(payload)
            to[order[start[k] + place]] = ids
        return _next(own.column("block")[0].as_py(), to[seq], owners)

    return numbered


def _paired(owners: int):
    """A block's next sequence: the id of each neighbouring pair."""

    def paired(own: pa.Table, back: pa.Table) -> pa.Table:
        (seq,) = unpack(own.column("payload")[0].as_py())
        left, right = seq[:-1], seq[1:]
        to = np.full(len(left), -1, np.int64)
        if len(back):
            code, ids = map(np.concatenate, zip(*map(unpack, back.column("payload").to_pylist())))
            order = np.argsort(code)
            code, ids = code[order], ids[order]
            at = np.flatnonzero((left >= 0) & (right >= 0))
            mine = (left[at] << BITS) | right[at]
            place = np.minimum(np.searchsorted(code, mine), len(code) - 1)
            to[at] = np.where(code[place] == mine, ids[place], -1)
        return _next(own.column("block")[0].as_py(), to, owners)

    return paired


# --- phrases --------------------------------------------------------------------


def frequent_phrases(docs: DataFrame, least: int = 100, longest: int = 5, lang_col: str = "lang", text_col: str = "text") -> tuple[DataFrame, list[DataFrame]]:
    """(lang, n) with all word occurrences, and for each length from 1 on the phrases that occur
    ``least`` times or more: id, lang, phrase, f, left and right (ids of the phrases without the last and the first word),
    head and tail (f of the first 1, 2, ... and of the last 1, 2, ... words), last (word).

    A-Z are lower-cased, texts are split at ``[.,;:!?\\n-\\r]`` and pieces into words
    ``[^ \\t]+``; a null language is ``und``, a null text empty.
    """
    spark = docs.sparkSession
    base = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    met = cut_lineage(base.mapInArrow(_dealt(BUCKETS * partitions(spark)), _DEALT_DDL))
    blocks = met.filter("kind = 0").select("block", "payload")
    n_blocks = blocks.count()
    owners = int(min(partitions(spark), max(4, 4 * n_blocks**0.5)))

    totals = cut_lineage(met.filter("kind = 2").groupBy("lang").agg(F.sum("n").alias("n")))
    packed = met.filter("kind = 1").select("bucket", "block", "payload")
    held = cut_lineage(packed.repartition(partitions(spark), "bucket").sortWithinPartitions("bucket").mapInArrow(_frequent_words(least), _HELD_DDL))
    first = cut_lineage(ranked(held.filter("word is not null").select("bucket", "num", "lang", "word", "f"), F.desc("f"), F.col("lang"), F.col("word")))
    word = F.col("word").cast("string")
    levels = [first.select("id", "lang", word.alias("phrase"), "f", F.lit(None).cast("long").alias("left"), F.lit(None).cast("long").alias("right"), F.array("f").alias("head"), F.array("f").alias("tail"), word.alias("last"))]
    places = held.filter("payload is not null").select("bucket", "block", "payload")
    known = places.groupBy("bucket").cogroup(first.select("bucket", "num", "id").groupBy("bucket")).applyInArrow(_word_ids, _ID_DDL)
    work = blocks.groupBy("block").cogroup(known.groupBy("of")).applyInArrow(_numbered(owners), _ROW_DDL)
    for length in range(2, longest + 1):
        work = cut_lineage(work)
        sent = work.filter("kind = 1").select("tile", "block", "payload")
        pairs = ranked(pair_counts(sent, n_blocks, least), F.desc("f"), F.col("code"))
        pairs = cut_lineage(pairs.withColumn("left", F.shiftright("code", BITS)).withColumn("right", F.col("code").bitwiseAND(F.lit(MASK))))
        if pairs.isEmpty():
            break
        if pairs.agg(F.max("id")).first()[0] > MASK:
            raise ValueError("more frequent phrases than ids")
        one = levels[-1].select(F.col("id").alias("left"), "lang", "phrase", "head")
        other = levels[-1].select(F.col("id").alias("right"), "tail", "last")
        both = pairs.join(one, "left").join(other, "right")
        levels.append(cut_lineage(both.select("id", "lang", F.concat_ws(" ", "phrase", "last").alias("phrase"), "f", "left", "right", F.concat("head", F.array("f")).alias("head"), F.concat("tail", F.array("f")).alias("tail"), "last")))
        if length < longest:
            back = pair_ids(sent, pairs, owners, n_blocks).select(F.col("block").alias("of"), "payload")
            work = work.filter("kind = 0").select("block", "payload").groupBy("block").cogroup(back.groupBy("of")).applyInArrow(_paired(owners), _ROW_DDL)
    return totals, levels


def collocations(docs: DataFrame, least: int = 100, longest: int = 5, best: int = 2000, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: of each language the first ``best`` phrases.

    ``a`` counts a phrase of 2 to ``longest`` words, ``n`` all words of the language. Cut after its first k
    words, with l and r the counts of the parts, it scores floor(1000 a n / (l r)); the cut with the smallest
    score counts, the first of equals. A phrase inside a longer one that occurs as often is left
    out. Order: score and a descending, phrase by bytes. Whole texts of all rows count, repeated rows
    too; ids are not read; an empty table, or one without frequent phrases, gives no rows.
    """
    totals, levels = frequent_phrases(docs, least, longest, lang_col, text_col)
    big = "decimal(38,0)"
    rows = None
    for phrases, longer in zip(levels[1:], [*levels[2:], None]):
        own = phrases.select("id", "lang", "phrase", "f", "head", "tail")
        if longer is not None:
            holds = longer.groupBy(F.col("left").alias("id")).agg(F.max("f").alias("most")).union(longer.groupBy(F.col("right").alias("id")).agg(F.max("f").alias("most")))
            holds = holds.groupBy("id").agg(F.max("most").alias("most"))
            own = own.join(holds, "id", "left").filter("most is null or most < f")
        own = own.select("lang", "phrase", "f", "head", "tail")
        rows = own if rows is None else rows.union(own)
    if rows is None:
        return totals.limit(0).select("lang", F.lit(0).cast("long").alias("rank"), F.lit("").alias("phrase"), *(F.lit(0).cast("long").alias(c) for c in ("a", "l", "r", "n", "score")))
    rows = rows.join(totals, "lang")
    cuts = F.expr(f"""transform(sequence(1, size(head) - 1), k -> struct(
        (cast(1000 as {big}) * cast(f as {big}) * cast(n as {big})) div (cast(head[k - 1] as {big}) * cast(tail[size(tail) - 1 - k] as {big})) as score,
        k as k, head[k - 1] as l, tail[size(tail) - 1 - k] as r))""")
    rows = rows.withColumn("cut", F.array_min(cuts)).select("lang", "phrase", F.col("f").alias("a"), "cut.l", "cut.r", "n", "cut.score")
    placed = cut_lineage(ranked(rows, F.col("lang"), F.desc("score"), F.desc("a"), F.col("phrase")))
    start = placed.groupBy("lang").agg(F.min("id").alias("start"))
    placed = placed.join(start, "lang").withColumn("rank", F.col("id") - F.col("start") + 1)
    return placed.filter(F.col("rank") <= best).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
