"""Pre-tokens of a lower-casing word-end BPE tokenizer file, and their ids.

Texts in characters whose normalisation is plain (``_PLAIN``) are split here
with the file's own pattern; any other text goes through the library's
normaliser and pre-tokenizer. Tests hold both against the library's ``encode``.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer, pre_tokenizers
from reckon.llm.common import RunHash, taken

#: Fixed values of the vocabulary file: its split pattern and its special strings.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SPECIAL = ("<|startoftext|>", "<|endoftext|>")

#: No composition applies to these characters, and lower-casing is by single characters.
_PLAIN = re.compile("[\t\n\r -~¡-įı-ž]*")
#: PATTERN for the lower-case forms of those characters, whose letters and numbers are listed.
_SPLIT = re.compile("'(?:s|t|re|ve|m|ll|d)|[a-zªµºß-öø-ž]+|[0-9²³¹¼-¾]|[^\\sa-zªµºß-öø-ž0-9²³¹¼-¾]+")
_AT_SPECIAL = re.compile("|".join(map(re.escape, SPECIAL)))
#: Marks a pre-token that is already in the byte alphabet.
MARK = "\x00"


class WordBpe:
    def __init__(self, path: str):
        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()
        vocab = self.lib.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        for piece, i in vocab.items():
            self.ends[i] = piece.endswith("</w>")
        self._bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)

    def is_plain(self, text: str) -> bool:
        """All characters plain, and no special string."""
        return _PLAIN.fullmatch(text) is not None and not ("<|" in text and _AT_SPECIAL.search(text))

    def plain(self, text: str) -> list[str] | None:
        """Pre-tokens of a plain text, else None."""
        return _SPLIT.findall(text.lower()) if self.is_plain(text) else None

    def pre_tokens(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens of any text, and the number of special strings in it."""
        words = self.plain(text)
        if words is not None:
            return words, 0
        words, parts = [], _AT_SPECIAL.split(text)
        for part in parts:
            got = self.plain(part)
            if got is None:
                whole = self.lib.normalizer.normalize_str(part)
                got = [MARK + w for w, _ in self.lib.pre_tokenizer.pre_tokenize_str(whole)]
            words += got
        return words, len(parts) - 1

    def _ids(self, word: str) -> list[int]:
        if not word.startswith(MARK):
            word = self._bytes.pre_tokenize_str(word)[0][0]
        else:
            word = word[1:]
        return [t.id for t in self.lib.model.tokenize(word)]

    def pieces(self, words: list[str]) -> list[np.ndarray]:
        """Ids of each pre-token. Plain ones are encoded together, parted by
        spaces: a piece with a word end closes each."""
        plain = [w for w in words if not w.startswith(MARK)]
        ids = np.array(self.lib.encode_batch_fast([" ".join(plain)], add_special_tokens=False)[0].ids if plain else [], "<u4")
        last = (np.flatnonzero(self.ends[ids]) + 1).tolist()
        if len(last) != len(plain):
            return [np.array(self._ids(w), "<u4") for w in words]
        parts = iter([ids[lo:hi] for lo, hi in zip([0, *last[:-1]], last)])
        if len(plain) == len(words):
            return list(parts)
        return [next(parts) if not w.startswith(MARK) else np.array(self._ids(w), "<u4") for w in words]

    def counts(self, words: list[str]) -> np.ndarray:
        out = [np.zeros(0, np.int64)]
        for k in range(0, len(words), 2000):
            out.append(np.array([len(x) for x in self.pieces(words[k : k + 2000])], np.int64))
        return np.concatenate(out)


@lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBpe:
    return WordBpe(path)


class Recent:
    """Keeps the last ``limit`` to twice as many values: the older half goes when the newer is full."""

    def __init__(self, limit: int):
        self.limit, self.now, self.old = limit, {}, {}

    def missing(self, keys: set) -> list:
        """Those of ``keys`` that must be computed; values of the older half move to the newer."""
        if len(self.now) > self.limit:
            self.now, self.old = {}, self.now
        new = keys.difference(self.now)
        if old := self.old:
            self.now.update((k, old[k]) for k in new if k in old)
            return [k for k in new if k not in old]
        return list(new)


#: Characters of a text from which on its bytes are not hashed as one array.
LONG = 4_000_000


class IdCache:
    """Ids of whole texts. Runs without white space (no pre-token spans two) are
    found by a 64-bit hash, and compared byte by byte, in a pool of at most ``runs`` of them; new ones are split,
    and only pre-tokens not seen lately are encoded. Texts that are not plain go to
    the library whole."""

    def __init__(self, bpe: WordBpe, runs: int = 500_000, words: int = 300_000):
        self.bpe, self.limit, self.words, self.hash = bpe, runs, Recent(words), RunHash()
        self.clear()

    def clear(self) -> None:
        self.known, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.start, self.pool = np.zeros(1, np.int64), np.zeros(0, "<u4")
        self.size, self.begin, self.bytes = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint8)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        plain = [len(t) < LONG and self.bpe.is_plain(t) for t in texts]
        found = iter(self._plain([t for t, p in zip(texts, plain) if p]))
        return [next(found) if p else np.array(self.bpe.lib.encode(t, add_special_tokens=False).ids, "<u4") for t, p in zip(texts, plain)]

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        raw = [t.lower().encode() for t in texts]
        whole = b" ".join(raw)
        data = np.frombuffer(whole, np.uint8)
        edge = np.flatnonzero(np.diff(data > 32, prepend=False, append=False))
        start, end = edge[::2], edge[1::2]
        run, first, at = np.unique(self.hash(data, start, end), return_index=True, return_inverse=True)
        if len(self.known) > self.limit:
            self.clear()
        have = np.searchsorted(self.known, run)
        new = (have == len(self.known)) | (self.known[np.minimum(have, len(self.known) - 1)] != run) if len(self.known) else np.ones(len(run), bool)
        if new.any():
            self._learn(run[new], [whole[a:b] for a, b in zip(start[first[new]].tolist(), end[first[new]].tolist())])
            have = np.searchsorted(self.known, run)
        place = self.place[have][at]
        # the bytes decide: where a run only has the hash of another one, the library encodes the texts
        if (self.size[place] != end - start).any() or (taken(self.bytes, self.begin[place], end - start) != taken(data, start, end - start)).any():
            return [np.array(self.bpe.lib.encode(t, add_special_tokens=False).ids, "<u4") for t in texts]
        size = self.start[place + 1] - self.start[place]
        upto = np.concatenate([[0], np.cumsum(size)])
        ids = self.pool[np.repeat(self.start[place] - upto[:-1], size) + np.arange(upto[-1])]
        ends = np.cumsum([len(r) + 1 for r in raw])  # of texts, with the space after
        cut = upto[np.searchsorted(start, ends)].tolist()
        return [ids[lo:hi] for lo, hi in zip([0, *cut[:-1]], cut)]

    def _learn(self, hashes: np.ndarray, runs: list[bytes]) -> None:
        size = np.array([len(r) for r in runs])
        self.begin = np.concatenate([self.begin, len(self.bytes) + np.cumsum(size) - size])
        self.size, self.bytes = np.concatenate([self.size, size]), np.concatenate([self.bytes, np.frombuffer(b"".join(runs), np.uint8)])
        parts = [_SPLIT.findall(r.decode()) for r in runs]
        new = self.words.missing(set().union(*parts))
        for k in range(0, len(new), 4000):
            part = new[k : k + 4000]
            self.words.now.update(zip(part, self.bpe.pieces(part)))
        known = self.words.now
        ids = [known[w] for words in parts for w in words]
        size = np.array([len(x) for x in ids])
        held = np.add.reduceat(size, np.cumsum([0, *map(len, parts[:-1])]))
        base = len(self.start) - 1
        self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(held)])
        self.pool = np.concatenate([self.pool, *ids])
        known, place = np.concatenate([self.known, hashes]), np.concatenate([self.place, base + np.arange(len(runs))])
        order = np.argsort(known, kind="stable")
        self.known, self.place = known[order], place[order]


#: Runs without white space and pre-tokens that a worker keeps.
CACHED = (500_000, 300_000)


@lru_cache(maxsize=2)
def id_cache(path: str, cached: tuple[int, int] = CACHED) -> IdCache:
    return IdCache(word_bpe(path), *cached)
