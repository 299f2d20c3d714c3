"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` bytes. Each passage is encoded
by its byte pairs (hashed, as square roots of shares), a learned hidden layer,
and gated attention: weight ~ exp(w . (tanh(V h) * sigmoid(U h))). The
weighted mean of the passages' hidden vectors gives the document's
probability. All layers are learned together from document labels alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reckon.llm.common import byte_texts, held_out, release

PASSAGE, PAIRS = 1024, 384
#: Bytes of text that are encoded at a time.
AT_ONCE = 1_000_000

_a, _b = np.divmod(np.arange(65536, dtype=np.int64), 256)
_PAIR = ((_a * 167 + _b * 59 + (_a >> 5) * 31 + (_b >> 5) * 101) % PAIRS).astype(np.int64)


def encode(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages, and the number of passages of each text (one at least)."""
    size = np.array([len(t) for t in texts], np.int64)
    n = np.maximum(1, -(-size // PASSAGE))
    first = np.cumsum(n) - n
    x = np.zeros((int(n.sum()), PAIRS + 3), np.float32)
    data = np.frombuffer(b"".join(texts), np.uint8)
    start = np.cumsum(size) - size
    passage = np.repeat(first, size) + (np.arange(len(data)) - np.repeat(start, size)) // PASSAGE
    if len(data) > 1:
        same = passage[1:] == passage[:-1]
        cell = passage[:-1] * PAIRS + _PAIR[data[:-1].astype(np.int64) * 256 + data[1:]]
        x[:, :PAIRS] = np.bincount(cell[same], minlength=len(x) * PAIRS).reshape(len(x), PAIRS)
    length = np.bincount(passage, minlength=len(x)).astype(np.float32)
    x[:, :PAIRS] = np.sqrt(x[:, :PAIRS] / np.maximum(1, length - 1)[:, None])
    k = 0
    for t in texts:
        for at in range(0, max(1, len(t)), PASSAGE):
            own = t[at : at + PASSAGE]
            x[k, PAIRS] = len(zlib.compress(own, 1)) / (len(own) + 12)  # low where a passage repeats itself
            k += 1
    x[:, PAIRS + 1] = np.log1p(length) / 7
    x[:, PAIRS + 2] = length == 0
    return x, n


def parts(texts: list[bytes]) -> Iterator[list[bytes]]:
    """Lists of texts, in order, that end at ``AT_ONCE`` bytes."""
    lo, held = 0, 0
    for hi in range(1, len(texts) + 1):
        held += len(texts[hi - 1])
        if held >= AT_ONCE or hi == len(texts):
            yield texts[lo:hi]
            lo, held = hi, 0


@dataclass
class Mil:
    """Weights by name; ``mean`` and ``scale`` standardise the features."""

    mean: np.ndarray
    scale: np.ndarray
    p: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, n: np.ndarray):
        p, at = self.p, np.cumsum(n) - n
        h = np.tanh(x @ p["W"] + p["b"])
        t, s = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = (t * s) @ p["w"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, at), n))
        a = e / np.repeat(np.add.reduceat(e, at), n)
        z = np.add.reduceat(a[:, None] * h, at, axis=0)
        return h, t, s, a, z, 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"], -30, 30)))

    def score(self, texts: list[bytes]) -> np.ndarray:
        out = [np.zeros(0)]
        for part in parts(texts):
            x, n = encode(part)
            out.append(self.forward((x - self.mean) / self.scale, n)[-1].astype(float))
        return np.concatenate(out)


def fit(texts: list[bytes], label: np.ndarray, hidden: int = 32, gate: int = 16, epochs: int = 30, rate: float = 3e-3, decay: float = 1e-4, seed: int = 7) -> Mil:
    """Adam on the cross-entropy, both classes weighing the same. One class alone gives a constant model."""
    rng = np.random.default_rng(seed)
    # encoded in parts, as the byte pairs of all texts at once would take many times their size
    x, n = map(np.concatenate, zip(*map(encode, parts(texts)))) if texts else (np.zeros((1, PAIRS + 3), np.float32), np.ones(1, np.int64))
    mean, scale = x.mean(0), x.std(0) + 0.02
    draw = lambda *s: rng.normal(0, s[0] ** -0.5, s).astype(np.float32)
    p = {"W": draw(x.shape[1], hidden), "b": np.zeros(hidden, np.float32), "V": draw(hidden, gate), "U": draw(hidden, gate), "w": draw(gate), "c": draw(hidden), "d": np.zeros(1, np.float32)}
    model = Mil(mean, scale, p)
    if not texts or len(np.unique(label)) < 2:
        p["c"][:] = 0
        p["d"][:] = 0 if not texts else (4 if label[0] else -4)
        return model
    x -= mean
    x /= scale
    start, weight = np.cumsum(n) - n, np.where(label == 1, 0.5 / (label == 1).mean(), 0.5 / (label == 0).mean())
    m, v, step = {k: np.zeros_like(w) for k, w in p.items()}, {k: np.zeros_like(w) for k, w in p.items()}, 0
    for epoch in range(epochs):
        order = rng.permutation(len(n))
        for lo in range(0, len(order), 64):
            docs = order[lo : lo + 64]
            nn = n[docs]
            xx = x[np.repeat(start[docs], nn) + np.arange(nn.sum()) - np.repeat(np.cumsum(nn) - nn, nn)]
            h, t, s, a, z, y = model.forward(xx, nn)
            dy = ((y - label[docs]) * weight[docs] / len(docs)).astype(np.float32)
            dz = dy[:, None] * p["c"]
            of = np.repeat(np.arange(len(docs)), nn)
            da = (h * dz[of]).sum(1)
            de = a * (da - np.repeat(np.add.reduceat(a * da, np.cumsum(nn) - nn), nn))
            dg = de[:, None] * p["w"]
            dt, ds = dg * s * (1 - t * t), dg * t * s * (1 - s)
            dh = (a[:, None] * dz[of] + dt @ p["V"].T + ds @ p["U"].T) * (1 - h * h)
            grad = {"W": xx.T @ dh, "b": dh.sum(0), "V": h.T @ dt, "U": h.T @ ds, "w": (t * s).T @ de, "c": z.T @ dy, "d": dy.sum(keepdims=True)}
            step += 1
            for k, g in grad.items():
                g = g + decay * p[k]
                m[k] += 0.1 * (g - m[k])
                v[k] += 0.001 * (g * g - v[k])
                p[k] -= (rate * (1 - epoch / epochs) * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return model


#: Labelled rows of each class that a model learns from, at most, and their bytes.
SAMPLE, SAMPLE_BYTES = 2000, 12_000_000
REMAINDER, THRESHOLD = 0, 0.3


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, remainder: int, id_col: str = "doc_id", text_col: str = "text") -> tuple[list[bytes], np.ndarray]:
    """Texts and labels of at most ``per_class`` rows of each class, those with the
    smallest hash of the id, without rows held out. A row labelled both ways counts as 0."""
    known = labels.select(F.col("doc_id").cast("long").alias("id"), F.col(label).cast("int").alias("label")).filter(f"id is not null and label in (0, 1) and not {_held('id', remainder)}")
    known = known.groupBy("id").agg(F.min("label").alias("label"))
    picked = [r for k in (0, 1) for r in known.filter(f"label = {k}").orderBy(F.xxhash64("id", F.lit(7)), "id").limit(per_class).collect()]
    picked = known.sparkSession.createDataFrame(picked, known.schema)
    picked = F.broadcast(picked)  # 2 * per_class ids
    found = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text")).join(picked, "id")
    found = found.select("id", "label", "text", F.length("text").alias("size"), F.crc32("text").alias("crc"))
    order = (F.xxhash64("id", F.lit(8)), "id", "size", "crc")
    # sizes first: only texts within the bound are sorted and come to the driver
    kept, size = set(), 0
    for r in found.select("id", "size", "crc").orderBy(*order).limit(2 * per_class).collect():
        if size + r.size <= SAMPLE_BYTES:
            kept.add((r.id, r.size, r.crc))
            size += r.size
    texts, y = [], []
    if kept:
        known = F.broadcast(known.sparkSession.createDataFrame(sorted(kept), "id long, size int, crc long"))
        for r in found.join(known, ["id", "size", "crc"]).orderBy(*order).limit(2 * per_class).toLocalIterator():
            texts.append(bytes(r.text))
            y.append(r.label)
    return texts, np.array(y, np.int64)


def _held(column: str, remainder: int) -> str:
    return f"crc32(cast(cast({column} as string) as binary)) % 5 = {remainder}"


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE) -> Mil:
    model = fit(*labelled_sample(docs, labels, "quality", per_class, REMAINDER))
    release()  # the driver's copy of the sample
    return model


def quality_scores(docs: DataFrame, model: Mil, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted, one row per input row, in the order of the input.

    The score is of the text alone: 0 to 1, higher when label 1 is likelier. A null text
    scores as an empty one; null ids are never held out; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few 10 kB, whatever the input

    def scored(batches):
        release()
        for b in batches:
            score = shared.value.score(byte_texts(b.column("text")))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(score, pa.float64()), pa.array((score >= THRESHOLD).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(F.col(id_col).cast("long"), REMAINDER).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    return base.mapInArrow(scored, "doc_id long, held_out boolean, score double, predicted int")


def keep_quality(docs: DataFrame, model: Mil, text_col: str = "text") -> DataFrame:
    """The rows, all columns, whose text the model does not reject."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def kept(batches):
        release()
        for b in batches:
            yield b.filter(pa.array(shared.value.score(byte_texts(b.column(at).cast(pa.string()))) >= THRESHOLD))

    return docs.mapInArrow(kept, docs.schema)
