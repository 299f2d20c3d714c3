"""Toxicity by classifier chains.

Categories are predicted one after the other by linear models over words and
word beginnings; each model also sees the probabilities of the categories
before it. While learning, those come from five-fold out-of-fold predictions,
so that a later model never trusts an earlier one on rows it has learned.

The tables label toxic documents without kinds. The earlier categories are
kinds found in the learning rows: clusters of the toxic documents by the terms
that speak for the label, the largest first. No word is given beforehand. The
last category is the label itself.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reckon.llm.common import BLOCK_WORDS, Vocab, byte_texts, held_out
from reckon.llm.quality import labelled_sample

#: Kinds of toxic documents that are told apart, and the chain: kinds by size, then the label.
KINDS = 3
CHAIN = (*(f"kind{k}" for k in range(1, KINDS + 1)), "toxic")
PREFIXES = (4, 5, 6)
#: Labelled rows of each class and terms that the models learn from, at most.
SAMPLE, TERMS = 2000, 600
REMAINDER, THRESHOLD, FOLDS = 0, 0.5, 5


def terms(word: str) -> list[str]:
    """The word without signs around it, and its beginnings."""
    word = word.strip("\"'`.,;:!?()[]{}*#&%$|-")
    return [word, *(f"{word[:n]}*" for n in PREFIXES if len(word) > n)] if word else []


def doc_terms(text: str) -> set[str]:
    return {t for w in set(text.lower().split()) for t in terms(w)}


@dataclass
class Chain:
    column: dict[str, int]
    weight: list[np.ndarray]  # of each category: terms, earlier categories, constant

    def predict(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros((len(x), 0))
        for w in self.weight:
            z = np.concatenate([x, out, np.ones((len(x), 1))], 1) @ w
            out = np.concatenate([out, 1 / (1 + np.exp(-np.clip(z, -30, 30)))[:, None]], 1)
        return out


def _fit(x: np.ndarray, y: np.ndarray, rounds: int = 100, rate: float = 0.15, decay: float = 2e-4) -> np.ndarray:
    """Logistic regression by Adam; the constant starts at the classes' odds and a single class keeps it."""
    x = np.concatenate([x, np.ones((len(x), 1))], 1).astype(np.float32)
    w, y = np.zeros(x.shape[1], np.float32), y.astype(np.float32)
    share = (y.sum() + 0.5) / (len(y) + 1)
    w[-1] = np.log(share / (1 - share))
    if not 0 < y.sum() < len(y):
        return w
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) / len(y) + decay * w
        m += 0.1 * (g - m)
        v += 0.001 * (g * g - v)
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w


def kinds(x: np.ndarray, label: np.ndarray, n: int = KINDS, rounds: int = 25, starts: int = 10, seed: int = 5) -> np.ndarray:
    """The kind of each toxic row of ``x`` (its terms), 0 the largest; -1 for others and for rows without a term.

    Spherical k-means, the best of some starts; the first centres are drawn apart from each other. Terms
    count by their rarity among the toxic rows, so that one in most of them joins nothing.
    """
    kind = np.full(len(x), -1)
    rows = np.flatnonzero((label > 0) & x.any(1)) if x.shape[1] else np.zeros(0, int)
    if not len(rows):
        return kind
    v = x[rows].astype(np.float64)
    v *= np.log((len(v) + 1) / v.sum(0).clip(1)) + 1e-9
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    rng, best = np.random.default_rng(seed), -1.0
    for _ in range(starts):
        centre = v[rng.integers(len(v))][None]
        while len(centre) < n:
            apart = (1 - (v @ centre.T).max(1)).clip(0) ** 2
            if apart.sum() <= 1e-9:
                break  # fewer kinds than asked for
            centre = np.concatenate([centre, v[rng.choice(len(v), p=apart / apart.sum())][None]])
        for _ in range(rounds):
            to = (v @ centre.T).argmax(1)
            for k in range(len(centre)):
                if (to == k).any():
                    mean = v[to == k].mean(0)
                    centre[k] = mean / np.linalg.norm(mean)
        like = v @ centre.T
        if like.max(1).sum() > best:
            best, near, found = like.max(1).sum(), like.argmax(1), len(centre)
    size = np.bincount(near, minlength=found)
    place = np.empty(found, int)
    place[np.argsort(-size, kind="stable")] = np.arange(found)
    kind[rows] = place[near]
    return kind


def fit(texts: list[str], label: np.ndarray) -> Chain:
    """Terms with the strongest evidence for the label, the kinds of toxic texts, then the chain."""
    held = [doc_terms(t) for t in texts]
    pos, neg = {}, {}
    for s, y in zip(held, label):
        into = pos if y else neg
        for t in s:
            into[t] = into.get(t, 0) + 1
    n1, n0 = max(1, int(label.sum())), max(1, int(len(label) - label.sum()))
    # signed evidence: documents of the class above what the other class' share explains
    gain = {t: n / n1 * np.log((n + 0.5) / (n1 + 1) * (n0 + 1) / (neg.get(t, 0) + 0.5)) for t, n in pos.items() if n >= 5 and n / n1 > 3 * neg.get(t, 0) / n0}
    column = {t: k for k, t in enumerate(sorted(gain, key=lambda t: (-gain[t], t))[:TERMS])}
    x = np.zeros((len(texts), len(column)), np.float32)
    for i, s in enumerate(held):
        x[i, [column[t] for t in s if t in column]] = 1
    fold = np.arange(len(texts)) % FOLDS
    seen, weight = x, []
    kind = kinds(x, label)
    for k in range(len(CHAIN)):
        y = (kind == k).astype(np.int64) if k < KINDS else label
        ahead = np.zeros(len(texts), np.float32)
        for f in range(FOLDS):
            if (fold == f).any():
                w = _fit(seen[fold != f], y[fold != f], rounds=50)
                ahead[fold == f] = 1 / (1 + np.exp(-np.clip(seen[fold == f] @ w[:-1] + w[-1], -30, 30)))
        weight.append(_fit(seen, y))
        seen = np.concatenate([seen, ahead[:, None]], 1)
    return Chain(column, weight)


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE) -> Chain:
    texts, y = labelled_sample(docs, labels, "toxic", per_class, REMAINDER)
    return fit([t.decode("utf-8", "replace") for t in texts], y)


def toxicity_scores(docs: DataFrame, model: Chain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, a probability per category (p_kind1 ..., p_toxic), score (the last
    one's), predicted (1 if score >= 0.5), one row per input row.

    A null text scores as an empty one; null ids are never held out; an empty
    table gives no rows. Texts are read whole. Term columns and weights are
    bounded by ``TERMS``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches):
        for b in batches:
            chain, out, texts = shared.value, [], byte_texts(b.column("text"))
            lo = 0
            while lo < len(texts):
                vocab, docs_, held = Vocab(), [], 0
                while lo < len(texts) and held < BLOCK_WORDS:
                    docs_.append(vocab.ids(texts[lo].decode("utf-8", "replace").lower().split()))
                    held += len(docs_[-1])
                    lo += 1
                cols = [[chain.column[t] for t in terms(w) if t in chain.column] for w in vocab]
                hit = np.array([bool(c) for c in cols], bool)
                for k in range(0, len(docs_), 512):
                    part = docs_[k : k + 512]
                    x = np.zeros((len(part), len(chain.column)))
                    for i, ids in enumerate(part):
                        for w in np.unique(ids[hit[ids]]) if len(ids) else ():
                            x[i, cols[w]] = 1
                    out.append(chain.predict(x))
            p = np.concatenate(out) if out else np.zeros((0, len(CHAIN)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), *(pa.array(p[:, k]) for k in range(len(CHAIN))), pa.array(p[:, -1]), pa.array((p[:, -1] >= THRESHOLD).astype(np.int32))], ["doc_id", "held_out", *(f"p_{c}" for c in CHAIN), "score", "predicted"])

    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(F.col(id_col).cast("long"), REMAINDER).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    return base.mapInArrow(scored, "doc_id long, held_out boolean, " + ", ".join(f"p_{c} double" for c in CHAIN) + ", score double, predicted int")
