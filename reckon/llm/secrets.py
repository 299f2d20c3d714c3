"""Secrets by fixed patterns and a linear-chain conditional random field.

The field tags white-space tokens as secret begin, inside or outside from
their shape, neighbouring words and file features, decoded by Viterbi. It
learns from a bounded sample of documents, in which the tokens of the
patterns' spans are the secrets, and from varied copies of those places
(``_varied``): other key words, separators, alphabets, cases and lengths, also
such as no pattern has, and key words in front of ordinary words, which are no
secrets. Its spans are added where no pattern's span is; pattern spans always stay.

Most tokens are plain (no digit, `=`, `_`, key word or change to upper case within,
and not long; no plain token's features depend on its letters) and lie between plain ones. When the
learned margin of "outside" for such a token is above anything that
transitions can gain (``Crf.safe``), the best path has it outside, and each
stretch around other tokens decodes on its own, exactly. Else whole texts are decoded.
"""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reckon.llm.common import rows_of

#: The patterns of the base spans, and the least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]{16,}"), re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "crf")
_HINTS = ("passw", "secret", "token", "key")

TABLE, CONTEXT = 1 << 12, 2
_TOKEN = re.compile(r"\S+")
#: Parts of the words that announce a secret.
_CUES = ("pass", "secret", "token", "key", "auth", "cred", "bearer", "pwd")
#: Tokens that are not plain: with a digit, `=` or `_`, a cue, a change to upper case, or long.
_OTHER = re.compile(r"(?<!\S)(?:\S*?[0-9=_]\S*|\S*?(?i:pass|secret|token|key|auth|cred|bearer|pwd)\S*|\S*?[a-z][A-Z]\S*|\S{24,})")
_SHAPES = (re.compile("[A-Z]+"), re.compile("[a-z]+"), re.compile("[0-9]+"), re.compile(r"[^\x00-\x7f]+"))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) by start, then kind."""
    out = []
    low = text.lower()
    if any(h in low for h in _HINTS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _shape(token: str) -> str:
    for sign, pattern in zip("Xxd~", _SHAPES):
        token = pattern.sub(sign, token)
    return token[:12]


def _bucket(x: float, *steps: float) -> int:
    return sum(x >= s for s in steps)


def file_features(text: str) -> list[str]:
    """Of the whole text: how dense its assignments and long digit runs are."""
    n = max(1, len(text))
    return [f"F{_bucket(1000 * text.count('=') / n, 0.5, 5, 20)}", f"L{_bucket(text.count(chr(10)) * 1000 / n, 1, 10, 30)}"]


def is_plain(token: str) -> bool:
    return _OTHER.fullmatch(token) is None


def features(tokens: list[str], i: int, file: list[str]) -> list[int]:
    """Numbers of the features of token i. A plain token between plain ones has the file's alone."""
    t = tokens[i]
    near = tokens[max(0, i - CONTEXT) : i + CONTEXT + 1]
    if all(map(is_plain, near)):
        out = ["plain", *file]
    else:
        low = t.lower().strip("\"'`,.;()[]{}")
        kinds = (any(c.isdigit() for c in low) << 1) | any(c.isalpha() for c in low)
        hexa = not set(low) - set("0123456789abcdef")
        out = [f"s{_shape(t)}", f"n{_bucket(len(low), 6, 12, 16, 20, 24, 32, 48)}", f"k{kinds}{hexa}{low.isupper()}", f"h{hexa}{_bucket(len(low), 16, 24, 32)}{kinds}", f"p{low[:4]}{_bucket(len(low), 16)}", f"v{_bucket(len(set(low)) / max(1, len(low)), 0.3, 0.5, 0.7)}", *file]
        inner = low.split("=", 1)[-1].split(":", 1)[-1]  # the value of a token that holds its key too
        out += [f"i{any(c in low for c in _CUES)}{t[-1] if t[-1] in ':=' else ''}{_bucket(len(inner), 6, 12, 16) if inner != low else ''}"]
        for d in (-2, -1, 1, 2):
            other = tokens[i + d] if 0 <= i + d < len(tokens) else "<>"
            word = "plain" if d < -1 or d > 1 else other.lower().strip("\"'`,.;()[]{}")[:12]
            if any(c in word for c in _CUES):
                out.append(f"q{d}{other[-1] if other[-1] in ':=' else ''}{kinds}{_bucket(len(low), 6, 10, 16)}")
            out += [f"w{d}{word if not is_plain(other) or word in ('=', ':') or any(h in word for h in _HINTS) else 'plain'}", f"c{d}{_shape(other) if not is_plain(other) else 'plain'}{kinds}"]
    return [zlib.crc32(f.encode("utf-8", "replace")) % TABLE for f in dict.fromkeys(out)]


@dataclass
class Crf:
    """Scores of the tags outside, begin, inside; inside only follows begin or inside."""

    weight: np.ndarray
    move: np.ndarray

    def emit(self, tokens: list[str], file: list[str], which: range) -> np.ndarray:
        return np.array([self.weight[features(tokens, i, file)].sum(0) for i in which])

    def safe(self, file: list[str]) -> bool:
        """A plain token whose neighbours have plain neighbourhoods too is outside on
        a best path: whatever the tags two before (a) and two after (b) it."""
        e, t = self.weight[features(["a"] * (2 * CONTEXT + 1), CONTEXT, file)].sum(0), self.move
        # best[a, y, b] over the tags of the tokens on either side of one tagged y
        left = (t[:, :, None] + e[None, :, None] + t[None]).max(1)
        best = left[:, :, None] + e[None, :, None] + left[None]
        return bool((best[:, 0] >= best[:, 1:].max(1)).all())

    def decode(self, emit: np.ndarray) -> np.ndarray:
        """Viterbi, from outside to outside."""
        best, back = emit[0] + self.move[0], []
        for e in emit[1:]:
            all_ = best[:, None] + self.move
            back.append(all_.argmax(0))
            best = all_.max(0) + e
        tag = [int((best + self.move[:, 0]).argmax())]
        for b in reversed(back):
            tag.append(int(b[tag[-1]]))
        return np.array(tag[::-1])


def _stretches(tokens: list[str], whole: bool) -> list[range]:
    """Token ranges around those that are not plain, ``CONTEXT`` + 1 more on either side; tokens between are ``safe``."""
    if whole:
        return [range(len(tokens))] if tokens else []
    out: list[range] = []
    for i in (k for k, t in enumerate(tokens) if not is_plain(t)):
        lo, hi = i - CONTEXT - 1, i + CONTEXT + 2
        lo, hi = 0 if lo <= 2 else lo, len(tokens) if hi >= len(tokens) - 2 else hi
        if out and lo <= out[-1].stop:
            out[-1] = range(out[-1].start, hi)
        else:
            out.append(range(lo, hi))
    return out


def _tags(spans: list[tuple[int, int]], secrets: list[tuple[int, int, int]]) -> np.ndarray:
    """0 outside, 1 begin, 2 inside, for tokens that overlap a pattern's span."""
    tag, k, last = np.zeros(len(spans), np.int64), 0, None
    secrets = sorted((s, e) for s, _, e in secrets)
    for i, (a, b) in enumerate(spans):
        while k < len(secrets) and secrets[k][1] <= a:
            k += 1
        hit = next((j for j in range(k, len(secrets)) if secrets[j][0] < b), None) if k < len(secrets) and secrets[k][0] < b else None
        if hit is not None:
            tag[i] = 2 if last is not None and i and tag[i - 1] and secrets[hit][0] < spans[i - 1][1] else 1
            last = hit
    return tag


#: Tokens of a stretch that are learned from at most, and varied copies of each learned secret.
STRETCH, COPIES, VARIED = 60, 16, 3000
#: Key words and alphabets of the varied copies.
_KEYS = ("password", "passwd", "secret", "token", "api_key", "auth_token", "client_secret", "access_key", "pwd", "credentials", "bearer", "authkey")
_HEX, _LOWER = "0123456789abcdef", "abcdefghijklmnopqrstuvwxyz"
_MIXED = _LOWER + _LOWER.upper() + "0123456789"


def _varied(tokens: list[str], tag: np.ndarray, rng: random.Random) -> tuple[list[str], np.ndarray]:
    """The stretch with its first secret in another form, or, one time in four, with a key word before ordinary words and no secret."""
    lo = int(np.flatnonzero(tag == 1)[0])
    hi = lo + 1
    while hi < len(tag) and tag[hi] == 2:
        hi += 1
    # half of the key words are made up around a cue, so that the cue is learned and not the word alone
    key = rng.choice(_KEYS) if rng.random() < 0.5 else rng.choice(_CUES) + "".join(rng.choices(_LOWER + "_", k=rng.randint(1, 7)))
    key = rng.choice((key, key.upper(), key.capitalize()))
    words = [t for t in tokens[:lo] + tokens[hi:] if is_plain(t) and t.strip("\"'`,.;:()[]{}|").isalpha()]
    if rng.random() < 0.25 and words:
        new = [rng.choice((key, key + ":")), *rng.choices(words, k=rng.randint(1, 3))]
        mark = [0] * len(new)
    else:
        kind = min(rng.randrange(8), 5)  # letters alone are the hardest: three in eight
        if kind < 2:
            value = "".join(rng.choices(_HEX, k=rng.randint(16, 48)))
            value = value.upper() if kind else value
        elif kind < 4:
            value = "".join(rng.choices(_MIXED, k=rng.randint(14, 44)))
        elif kind == 4:
            value = "".join(rng.choices(_LOWER, k=rng.randint(2, 4))) + rng.choice("_-") + "".join(rng.choices(_MIXED, k=rng.randint(16, 44)))
        else:
            value = "".join(rng.choices(_LOWER, k=rng.randint(14, 26)))
        value = rng.choice((value, value, f'"{value}"', f"'{value}'"))
        forms = [[key + ":", value], [key, "=", value], [f"{key}={value}"], [f"{key}:{value}"], [key, value]]
        new = rng.choice(forms if kind == 5 else [*forms, [value]])
        mark = [1] + [2] * (len(new) - 1)
    return tokens[:lo] + new + tokens[hi:], np.array([*tag[:lo], *mark, *tag[hi:]], np.int64)


def train(texts: list[str], rounds: int = 80, rate: float = 0.2, decay: float = 2e-4) -> Crf:
    """Adam on the conditional log-likelihood of the sample's stretches, by forward-backward sums."""
    rows, tags, rng, varied = [], [], random.Random(7), 0
    for text in texts:
        found = [(m.start(), m.end()) for m in _TOKEN.finditer(text)]
        tokens, gold, file = [text[a:b] for a, b in found], _tags(found, base_spans(text)), file_features(text)
        for part in _stretches(tokens, False) or [range(min(20, len(tokens)))]:
            part = range(max(0, part.start - 8), min(part.stop + 8, part.start + STRETCH, len(tokens)))
            if len(part):
                rows.append([features(tokens, i, file) for i in part])
                tags.append(gold[part.start : part.stop])
                for _ in range(COPIES if (tags[-1] == 1).any() and varied < VARIED else 0):
                    near, tag = _varied(tokens[part.start : part.stop], gold[part.start : part.stop], rng)
                    rows.append([features(near, i, file) for i in range(len(near))])
                    tags.append(tag)
                    varied += 1
    weight, move = np.zeros((TABLE, 3)), np.zeros((3, 3))
    move[0, 2] = -50.0  # inside never follows outside
    if not rows:
        weight[:, 0] = 1.0
        return Crf(weight, move)
    long, n = max(map(len, rows)), len(rows)
    size = np.array([len(r) for r in rows])
    there = np.arange(long)[None] < size[:, None]
    seq, pos, feat = (np.array(x) for x in zip(*((s, i, f) for s, r in enumerate(rows) for i, fs in enumerate(r) for f in fs)))
    gold = np.zeros((n, long), np.int64)
    for s, t in enumerate(tags):
        gold[s, : len(t)] = t
    empirical = np.zeros((TABLE, 3))
    np.add.at(empirical, (feat, gold[seq, pos]), 1)
    before = np.concatenate([np.zeros((n, 1), np.int64), gold], 1)  # outside before the first and after the last
    after = np.concatenate([gold, np.zeros((n, 1), np.int64)], 1)
    steps = np.concatenate([there, np.zeros((n, 1), bool)], 1)
    steps[np.arange(n), size] = True
    seen = np.zeros((3, 3))
    np.add.at(seen, (before[steps], after[steps]), 1)
    m1, v1, m2, v2 = np.zeros_like(weight), np.zeros_like(weight), np.zeros_like(move), np.zeros_like(move)
    lse = lambda x, axis: (m := x.max(axis, keepdims=True)).squeeze(axis) + np.log(np.exp(x - m).sum(axis))
    for step in range(1, rounds + 1):
        emit = np.zeros((n, long, 3))
        np.add.at(emit, (seq, pos), weight[feat])
        alpha, beta = np.zeros((n, long, 3)), np.zeros((n, long, 3))
        alpha[:, 0] = emit[:, 0] + move[0]
        for i in range(1, long):
            alpha[:, i] = np.where(there[:, i, None], lse(alpha[:, i - 1, :, None] + move, 1) + emit[:, i], alpha[:, i - 1])
        total = lse(alpha[:, -1] + move[:, 0], 1)
        beta[np.arange(n), size - 1] = move[:, 0]
        for i in range(long - 2, -1, -1):
            b = lse(move[None] + (emit[:, i + 1] + beta[:, i + 1])[:, None, :], 2)
            beta[:, i] = np.where((size - 1 > i)[:, None], b, beta[:, i])
        p = np.where(there[..., None], np.exp(alpha + beta - total[:, None, None]), 0)
        expected = np.zeros((TABLE, 3))
        np.add.at(expected, feat, p[seq, pos])
        pair = np.exp(alpha[:, :-1, :, None] + move + (emit[:, 1:] + beta[:, 1:])[:, :, None, :] - total[:, None, None, None])
        moved = (pair * there[:, 1:, None, None]).sum((0, 1))
        moved[0] += p[:, 0].sum(0)
        moved[:, 0] += p[np.arange(n), size - 1].sum(0)
        g1, g2 = (expected - empirical) / n + decay * weight, (moved - seen) / n + decay * move
        g2[0, 2] = 0
        for w, g, m, v in ((weight, g1, m1, v1), (move, g2, m2, v2)):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            w -= rate * (1 - step / (rounds + 1)) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Crf(weight, move)


def crf_spans(text: str, model: Crf) -> list[tuple[int, int]]:
    """Character ranges of the tokens that the best path tags as secrets."""
    file = file_features(text)
    safe = model.safe(file)
    if safe and not _OTHER.search(text):
        return []
    found = [(m.start(), m.end()) for m in _TOKEN.finditer(text)]
    tokens, out = [text[a:b] for a, b in found], []
    for part in _stretches(tokens, not safe):
        for i, tag in zip(part, model.decode(model.emit(tokens, file, part))):
            if tag == 1:
                out.append([found[i][0], found[i][1]])
            elif tag == 2:
                out[-1][1] = found[i][1]
    return [(a, b) for a, b in out]


def all_spans(text: str, model: Crf) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and base and added spans, each by start, then kind."""
    base = base_spans(text)
    added = [(a, 3, b) for a, b in crf_spans(text, model) if not any(s < b and a < e for s, _, e in base)]
    return base, sorted(base + added)


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


#: Documents that the field learns from, at most (those with the smallest hash of the id), and their bytes.
SAMPLE, SAMPLE_BYTES = 6000, 20_000_000


def learn(docs: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> Crf:
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).filter("text is not null")
    texts, size = [], 0
    picked = base.sparkSession.createDataFrame(base.select("id").orderBy(F.xxhash64("id", F.lit(4)), "id").limit(sample).collect(), "id long").distinct()
    found = base.join(F.broadcast(picked), "id")  # at most ``sample`` ids
    found = found.select("id", "text", F.octet_length("text").alias("size"), F.crc32(F.col("text").cast("binary")).alias("crc"), F.col("text").rlike(_OTHER.pattern).alias("other"))
    order = (F.xxhash64("id", F.lit(4)), "id", "crc")
    # sizes first: only texts within the bound are sorted and come to the driver
    kept = []
    for r in found.select("id", "size", "crc", "other").orderBy(*order).limit(sample).collect():
        if size + r.size <= SAMPLE_BYTES and (len(kept) < sample // 10 or r.other):
            kept.append((r.id, r.size, r.crc))
            size += r.size
    if kept:
        kept = F.broadcast(base.sparkSession.createDataFrame(sorted(set(kept)), "id long, size int, crc long"))
        texts = [r.text for r in found.join(kept, ["id", "size", "crc"]).orderBy(*order).limit(sample).toLocalIterator()]
    return train(texts)


def secret_scan(docs: DataFrame, model: Crf, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_crf, one row per input row.

    Offsets are code points, ends exclusive. A null text counts as empty: no spans, and
    the hash of the empty string. Null ids and repeated rows are kept; an empty table
    gives no rows. Texts are scanned whole.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 100 kB, whatever the input
    ddl = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_crf long"

    def scanned(batches):
        for b in batches:
            out = []
            for i, raw in rows_of([b], "id", "text"):
                base, spans = all_spans(raw.decode("utf-8", "replace"), shared.value)
                n = [sum(k == kind for _, k, _ in base) for kind in range(3)]
                out.append((i, *n, hashlib.sha256(written(base).encode()).hexdigest(), written(spans), len(spans) - len(base)))
            if out:
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4]), pa.array(cols[5]), pa.array(cols[6], pa.int64())], [x.split()[0] for x in ddl.split(", ")])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(scanned, ddl)
