"""Alignment of the tokens of two tokenizers, and corpus-wide counts of linked ids.

A is a byte-level BPE file that encodes a space and the text, B a sentencepiece
file that adds the space itself; both sides then spell the same bytes. In a
batch of documents each token start looks up the covering token of the other
side with ``pandas.merge_asof``, keyed by document; the union of both
directions are the overlaps. An overlap whose tokens end together closes a
group, and every A token of a group is linked to every B token of it.

Counting is an exchange: a block of documents keeps its (pair, document)
entries packed and sends each distinct pair once; pairs are counted and ranked
in Spark and go back to the blocks that hold them. A pair found in every
document so costs one row a block, and its rows are summed before the shuffle.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from reckon.llm.common import BLOCK_DOCS, batch, by_bytes, pack, release, rows_of, runs, taken, task_id, unpack
from reckon.session import cut_lineage

#: Bytes of text of a block, bytes that are aligned at a time, links that are expanded at a time, and
#: stretches whose ids a worker keeps.
BLOCK_BYTES, AT_ONCE, LINKS, KEPT = 6_000_000, 1_000_000, 1_000_000, 400_000

#: Bytes that stand for themselves in a byte-level vocabulary (the others follow from
#: code point 256 on), and the letter that stands for a space in the other.
SELF_BYTES = [*range(33, 127), *range(161, 173), *range(174, 256)]
SPACE = "▁"


def _byte_letters() -> dict[str, int]:
    out = {chr(b): b for b in SELF_BYTES}
    for n, b in enumerate(b for b in range(256) if b not in set(SELF_BYTES)):
        out[chr(256 + n)] = b
    return out


#: Where a text may be cut: before a space after another character and before one that is no white
#: space (a letter of these first bytes never is). A begins a token there, and so does B if no piece of its goes on into a space.
_FIRST = re.compile(rb"[!-~\xc3-\xdf\xe4-\xed]")
_CUT = re.compile(rb"(?<=[^ ]) (?=" + _FIRST.pattern + rb")")


class Spelling:
    """The bytes of each id."""

    def __init__(self, spelled: list[bytes]):
        self.size = np.array([len(x) for x in spelled], np.int64)
        self.start, self.pool = np.cumsum(self.size) - self.size, np.frombuffer(b"".join(spelled), np.uint8)

    def right(self, ids: np.ndarray, n: np.ndarray, whole: bytes, size: np.ndarray) -> np.ndarray:
        """Whether the ids of each stretch, ``n`` of them, spell its ``size`` bytes in ``whole``."""
        long = np.concatenate([[0], np.cumsum(self.size[ids])])
        upto = np.cumsum(n)
        out = long[upto] - long[upto - n] == size
        data, fit = np.frombuffer(whole, np.uint8), np.repeat(out, n)
        same = np.concatenate([[0], np.cumsum(taken(self.pool, self.start[ids[fit]], self.size[ids[fit]]) == data[np.repeat(out, size)])])
        ends = np.cumsum(size[out])
        out[out] = same[ends] - same[ends - size[out]] == size[out]
        return out


class Pool:
    """Ids of stretches of text, laid end to end; stretch k has those from ``at[k]`` to ``at[k + 1]``."""

    def __init__(self):
        self.ids, self.at = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def add(self, ids: np.ndarray, n: np.ndarray) -> None:
        self.ids = np.concatenate([self.ids, ids])
        self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(n)])

    def __call__(self, stretch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the stretches, and their number for each."""
        size = np.diff(self.at)[stretch]
        return taken(self.ids, self.at[stretch], size), size


class Tokenizers:
    """Both tokenizers, with the spelling of their ids. No special tokens are added, and their
    strings in a text are plain text. Texts are cut where both sides begin a token, and the
    ids of ``KEPT`` stretches are remembered, by their bytes."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.a = Tokenizer.from_file(path_a)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters, vocab = _byte_letters(), self.a.get_vocab(with_added_tokens=False)
        spelled = [b""] * (max(self.a.get_vocab(with_added_tokens=True).values()) + 1)
        for piece, i in vocab.items():
            spelled[i] = bytes(letters[c] for c in piece) if all(c in letters for c in piece) else piece.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.spell_a = Spelling(spelled)
        self.spell_b = Spelling([bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)])
        self.cuttable = not any(SPACE in p.lstrip(SPACE) for i, p in enumerate(pieces) if not self.b.is_byte(i))
        self.n_b = len(pieces)
        n = max(len(spelled), self.n_b)
        self.digits = np.array([np.frombuffer(str(i).encode().rjust(len(str(n)), b"\0"), np.uint8) for i in range(n)])
        self.clear()

    def clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.pool_a, self.pool_b, self.spelled = Pool(), Pool(), np.zeros(0, bool)

    def learn(self, new: list[bytes], together: bool) -> None:
        """Encodes stretches, each after a space; those that a side does not spell are marked. Stretches
        that may follow each other are encoded ``together`` by A, which spells all that it reads, and told apart by their bytes."""
        texts, size = [w.decode("utf-8", "replace") for w in new], np.fromiter(map(len, new), np.int64, len(new)) + 1
        if together:
            a = np.array(self.a.encode_batch_fast([" " + " ".join(texts)], add_special_tokens=False)[0].ids, np.int32)
            end, upto = np.cumsum(self.spell_a.size[a]), np.cumsum(size)
            last = np.searchsorted(end, upto)
            if end[-1] != upto[-1] or (end[last] != upto).any():
                return self.learn(new, False)
            n_a = np.diff(last, prepend=-1)
        else:
            a = [e.ids for e in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
            a, n_a = np.array(list(chain.from_iterable(a)), np.int32), np.array([len(x) for x in a], np.int64)
        b = self.b.encode(texts, num_threads=1)
        b, n_b = np.array(list(chain.from_iterable(b)), np.int32), np.array([len(x) for x in b], np.int64)
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
        self.pool_a.add(a, n_a)
        self.pool_b.add(b, n_b)
        whole = b" " + b" ".join(new)
        self.spelled = np.concatenate([self.spelled, self.spell_a.right(a, n_a, whole, size) & self.spell_b.right(b, n_b, whole, size)])

    def encode(self, texts: list[bytes]) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """For A and B the ids of all texts, and the number of each text. A text that is empty, or that a side does not spell, has none."""
        cut = [(_CUT.split(t) if self.cuttable else [t]) if t else [] for t in texts]
        n = np.array([len(c) for c in cut], np.int64)
        words = list(chain.from_iterable(cut))
        if len(self.known) > KEPT:
            self.clear()
        new = set(words).difference(self.known)
        for together in (True, False):
            own = [w for w in new if (self.cuttable and _FIRST.match(w) is not None) is together]
            for k in range(0, len(own), 30_000):
                self.learn(own[k : k + 30_000], together)
        at = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        doc = np.repeat(np.arange(len(texts)), n)
        wrong = np.zeros(len(texts), bool)
        wrong[doc[~self.spelled[at]]] = True
        keep = ~wrong[doc]
        at, doc, out = at[keep], doc[keep], []
        for pool in (self.pool_a, self.pool_b):
            ids, size = pool(at)
            out.append((ids, np.bincount(doc, size, len(texts)).astype(np.int64)))
        return tuple(out)


@lru_cache(maxsize=2)
def tokenizers(path_a: str, path_b: str) -> Tokenizers:
    return Tokenizers(path_a, path_b)


@dataclass
class Side:
    """Tokens of a batch, document by document: ids, document, and first byte and end, counted over the batch."""

    ids: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray

    def frame(self, name: str) -> pd.DataFrame:
        return pd.DataFrame({"at": self.start, "doc": self.doc, name: np.arange(len(self.ids))})


def side(ids: np.ndarray, n: np.ndarray, size: np.ndarray) -> Side:
    end = np.cumsum(size[ids])
    return Side(ids, np.repeat(np.arange(len(n)), n), end - size[ids], end)


def overlaps(a: Side, b: Side) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of tokens (by their places in a and b) that share a byte: for each start in a the covering
    token of b, then for each start in b that is no start in a the covering token of a."""
    left, right = a.frame("a"), b.frame("b")
    there, back = pd.merge_asof(left, right, on="at", by="doc"), pd.merge_asof(right, left, on="at", by="doc")
    of = back["a"].to_numpy(np.int64)
    new = a.start[of] < b.start
    return np.concatenate([np.arange(len(a.ids)), of[new]]), np.concatenate([there["b"].to_numpy(np.int64), np.flatnonzero(new)])


@dataclass
class Aligned:
    """Tokens of a batch of ``n`` documents and the group (counted over the batch) of each."""

    n: int
    a: Side
    b: Side
    group_a: np.ndarray
    group_b: np.ndarray
    last_a: np.ndarray  # the last A and B token of each group
    last_b: np.ndarray

    @property
    def size_a(self) -> np.ndarray:
        return np.diff(self.last_a, prepend=-1)

    @property
    def size_b(self) -> np.ndarray:
        return np.diff(self.last_b, prepend=-1)

    @property
    def doc(self) -> np.ndarray:
        """Document of each group."""
        return self.a.doc[self.last_a]


def _groups(last: np.ndarray, n: int) -> np.ndarray:
    """The number of groups that end before each of ``n`` tokens."""
    begins = np.zeros(n + 1, np.int64)
    begins[last + 1] = 1
    return np.cumsum(begins)[:n]


def align(texts: list[bytes], tok: Tokenizers) -> Aligned:
    """Aligns the tokens of each text. A text that is empty, or that the tokens of a side do not spell, has none."""
    (ids_a, n_a), (ids_b, n_b) = tok.encode(texts)
    a, b = side(ids_a, n_a, tok.spell_a.size), side(ids_b, n_b, tok.spell_b.size)
    over_a, over_b = overlaps(a, b)
    closes = a.end[over_a] == b.end[over_b]
    last_a, last_b = np.sort(over_a[closes], kind="stable"), np.sort(over_b[closes], kind="stable")
    return Aligned(len(texts), a, b, _groups(last_a, len(a.ids)), _groups(last_b, len(b.ids)), last_a, last_b)


def digests(x: Aligned, digits: np.ndarray) -> list[str]:
    """SHA-256 of each document's groups, written as ``a1,a2|b1;a3|b2,b3``; '' without tokens.
    ``digits`` are those of each id, filled up by zero bytes."""
    n_a, n_b = len(x.a.ids), len(x.b.ids)
    text = np.empty((n_a + n_b, digits.shape[1] + 1), np.uint8)
    text[:, -1] = ord(",")
    place_a = np.arange(n_a) + np.concatenate([[0], x.last_b + 1])[x.group_a]
    place_b = np.arange(n_b) + (x.last_a + 1)[x.group_b]
    text[place_a, :-1], text[place_b, :-1] = digits[x.a.ids], digits[x.b.ids]
    text[place_a[x.last_a], -1], text[place_b[x.last_b], -1] = ord("|"), ord(";")
    n = np.bincount(x.a.doc, minlength=x.n) + np.bincount(x.b.doc, minlength=x.n)
    ends = np.cumsum(n)
    text[ends[n > 0] - 1, -1] = 0
    used = text != 0
    size = np.concatenate([[0], np.cumsum(used.sum(1))])[np.concatenate([[0], ends])].tolist()
    flat = text[used].tobytes()
    return [hashlib.sha256(flat[lo:hi]).hexdigest() if hi > lo else "" for lo, hi in zip(size[:-1], size[1:])]


def _counted(key: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(key, kind="stable")
    key, times = key[order], times[order]
    at = runs(key)[:-1]
    return key[at], np.add.reduceat(times, at) if len(at) else times


def links(x: Aligned, n_b: int) -> tuple[np.ndarray, np.ndarray]:
    """(pair * BLOCK_DOCS + document, links) for each linked pair a * ``n_b`` + b of a document, sorted.

    ``LINKS`` links at a time are written out; a group with more is first reduced to its distinct ids."""
    size_a, size_b = x.size_a, x.size_b
    per, found, held = size_a * size_b, [(np.zeros(0, np.int64), np.zeros(0, np.int64))], 0
    wide = np.flatnonzero(per > LINKS)
    narrow = np.where(per > LINKS, 0, per)
    upto = np.concatenate([[0], np.cumsum(narrow)])
    cuts = np.unique(np.concatenate([np.searchsorted(upto, np.arange(0, upto[-1], LINKS)), [len(per)]]))
    for lo, hi in zip(np.concatenate([[0], cuts[:-1]]), cuts):
        g = np.flatnonzero(narrow[lo:hi]) + lo
        if not len(g):
            continue
        group = np.repeat(g, narrow[g])
        k = np.arange(len(group)) - np.repeat(upto[g] - upto[g[0]], narrow[g])
        a = x.a.ids[(x.last_a - size_a + 1)[group] + k // size_b[group]].astype(np.int64)
        b = x.b.ids[(x.last_b - size_b + 1)[group] + k % size_b[group]]
        key, times = np.unique((a * n_b + b) * BLOCK_DOCS + x.doc[group], return_counts=True)
        found.append((key, times.astype(np.int64)))
        held += len(key)
    for g in wide.tolist():
        a, times_a = np.unique(x.a.ids[x.last_a[g] - size_a[g] + 1 : x.last_a[g] + 1], return_counts=True)
        b, times_b = np.unique(x.b.ids[x.last_b[g] - size_b[g] + 1 : x.last_b[g] + 1], return_counts=True)
        for i in range(0, len(a), max(1, LINKS // len(b))):
            part = slice(i, i + max(1, LINKS // len(b)))
            pair = a[part, None].astype(np.int64) * n_b + b
            found.append(((pair * BLOCK_DOCS + x.doc[g]).ravel(), (times_a[part, None] * times_b).ravel()))
    return _counted(*map(np.concatenate, zip(*found)))


# --- the exchange -------------------------------------------------------------

_ROW = pa.schema([("kind", pa.int32()), ("block", pa.int64()), ("row", pa.int32()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("sha", pa.string()), ("pair", pa.int64()), ("docs", pa.int64()), ("payload", pa.binary())])
_DDL = "kind int, block long, row int, doc_id long, n_a long, n_b long, n_groups long, n_links long, sha string, pair long, docs long, payload binary"
_OUT = pa.schema([*((c, pa.int64()) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")), ("groups_sha256", pa.string())])


def _blocks(path_a: str, path_b: str):
    """Rows of kind 0 for documents, 1 for the distinct pairs of a block, 2 for its packed entries."""

    def blocks(batches: Iterator[pa.RecordBatch]):
        release(tokens=False)
        tok, n_block = tokenizers(path_a, path_b), 0
        for rows in by_bytes(rows_of(batches, "id", "text"), BLOCK_BYTES):
            for lo in range(0, len(rows), BLOCK_DOCS - 1):
                own, found = rows[lo : lo + BLOCK_DOCS - 1], []
                block, done = (task_id() << 24) + n_block, 0
                n_block += 1
                for part in by_bytes(own, AT_ONCE):
                    x, n = align([t for _, t in part], tok), len(part)
                    total = np.zeros(n, np.int64)
                    np.add.at(total, x.doc, x.size_a * x.size_b)
                    yield batch(_ROW, [0] * n, [block] * n, range(done, done + n), [i for i, _ in part], np.bincount(x.a.doc, minlength=n), np.bincount(x.b.doc, minlength=n), np.bincount(x.doc, minlength=n), total, digests(x, tok.digits), [None] * n, [None] * n, [None] * n)
                    key, times = links(x, tok.n_b)
                    found.append((key + done, times))
                    done += n
                key, times = _counted(*map(np.concatenate, zip(*found)))
                pair = key // BLOCK_DOCS
                at = runs(pair)
                docs, m = np.diff(at), len(at) - 1
                none = [None] * m
                if m:
                    yield batch(_ROW, [1] * m, [block] * m, *[none] * 7, pair[at[:-1]], docs, none)
                    packed = pack(docs.astype(np.uint16), (key % BLOCK_DOCS).astype(np.uint16), np.minimum(times, 255).astype(np.uint8), times[times >= 255])
                    yield batch(_ROW, [2], [block], *[[None]] * 9, [packed])

    return blocks


def _finish(own: pa.Table, known: pa.Table) -> pa.Table:
    """The documents of a block with the sums over their links."""
    kind = own.column("kind").to_numpy()
    rows = own.filter(pa.array(kind == 0)).sort_by("row")
    best, count = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
    if (kind == 2).any():
        docs, doc, times, large = unpack(own.filter(pa.array(kind == 2)).column("payload")[0].as_py())
        times = times.astype(np.int64)
        times[times == 255] = large
        order = np.argsort(known.column("pair").to_numpy())
        n, top = known.column("n").to_numpy()[order], known.column("top").to_numpy()[order]
        if len(n) != len(docs):
            raise ValueError("a block did not get all its pairs back")
        np.add.at(count, doc, times * np.repeat(n, docs))
        np.add.at(best, doc, times * np.repeat(n == top, docs))
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links")
    return pa.Table.from_arrays([*(rows.column(c).combine_chunks() for c in names), pa.array(best), pa.array(count), rows.column("sha").combine_chunks()], schema=_OUT)


def _base(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))


def alignment_counts(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, one row per input row.

    A linked pair of ids counts the documents that hold it, over the whole table; ``n_best``
    are the links whose pair counts as many as any pair of its A id, ``count_sum`` sums the
    counts over all links. Null and empty texts, and texts that a tokenizer does not spell
    byte by byte, have zeros and ''. Null ids and repeated rows are documents like any others; an empty
    table gives no rows; texts are taken whole.
    """
    n_b = tokenizers(path_a, path_b).n_b
    met = cut_lineage(_base(docs, id_col, text_col).mapInArrow(_blocks(path_a, path_b), _DDL))
    pairs = met.filter("kind = 1").select("block", "pair", "docs")
    counts = cut_lineage(pairs.groupBy("pair").agg(F.sum("docs").alias("n")).withColumn("a", F.expr(f"pair div {n_b}")))
    known = counts.join(counts.groupBy("a").agg(F.max("n").alias("top")), "a").select("pair", "n", "top")
    back = pairs.join(known, "pair").select(F.col("block").alias("of"), "pair", "n", "top")
    own = met.filter("kind <> 1").drop("pair", "docs")
    ddl = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return own.groupBy("block").cogroup(back.groupBy("of")).applyInArrow(_finish, ddl)


def token_groups(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, groups, one row per input row: the byte range of each group (of a space and the text)
    and its ids by both tokenizers. Edge cases as in ``alignment_counts``, with no groups."""
    ints = pa.list_(pa.int32())
    schema = pa.schema([("doc_id", pa.int64()), ("groups", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("a", ints), ("b", ints)])))])

    def grouped(batches: Iterator[pa.RecordBatch]):
        tok = tokenizers(path_a, path_b)
        for rows in by_bytes(rows_of(batches, "id", "text"), AT_ONCE):
            x = align([t for _, t in rows], tok)
            end, first = x.a.end[x.last_a], np.searchsorted(x.a.doc, np.arange(x.n))
            base = np.concatenate([x.a.start, [0]])[first][x.doc]  # where the group's document begins
            start = x.a.start[x.last_a - x.size_a + 1] - base
            cut = lambda last, ids: pa.ListArray.from_arrays(pa.array(np.concatenate([[0], last + 1]), pa.int32()), pa.array(ids, pa.int32()))
            parts = pa.StructArray.from_arrays([pa.array(start), pa.array(end - base), cut(x.last_a, x.a.ids), cut(x.last_b, x.b.ids)], fields=list(schema.field("groups").type.value_type))
            at = np.concatenate([[0], np.cumsum(np.bincount(x.doc, minlength=x.n))])
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int64()), pa.ListArray.from_arrays(pa.array(at, pa.int32()), parts)], schema=schema)

    return _base(docs, id_col, text_col).mapInArrow(grouped, "doc_id long, groups array<struct<start: long, end: long, a: array<int>, b: array<int>>>")
