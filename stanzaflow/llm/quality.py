"""Quality classification by attention-based multiple-instance learning.

A document is a bag of passages (``PASSAGE`` bytes each, the last one shorter).
Each passage is encoded from the frequencies of its byte-class bigrams and of
hashed byte 4-grams by one dense layer; gated attention (Ilse, Tomczak and
Welling, "Attention-based Deep Multiple Instance Learning", 2018) weighs the
passages, learned from document labels alone, and the score is a logistic unit
on the weighted sum. Training runs on a bounded sample of labelled documents (of
a very long one, ``LEARNED`` passages spread over all of it), and the bias then returns to the share of classes among all of them, so scores
do not depend on how far the bound reaches; scoring reads every passage of every
text.

Defined results: null and empty texts are one empty passage and get the score
the model gives it; without labels of both classes every score is the share of
label 1 (0.5 if there are none); an empty table gives no rows; repeated rows get
equal values; a document with several labels counts once, with the smallest
label, and one with several texts with the first in order; a null doc_id is never held out and never trained on; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PASSAGE = 512
#: Bound on the labelled documents of each class that are learned from.
SAMPLE = 1500
#: Bound on the passages of a document that are learned from.
LEARNED = 64
HASHED = 512
HIDDEN = 32
ATTENTION = 16
EPOCHS = 60
THRESHOLD = 0.3


def _classes() -> tuple[np.ndarray, int]:
    table = np.zeros(256, np.int64)
    groups = [b"aeiou", b"bcdfghjklmnpqrstvwxyz", bytes(range(65, 91)), b"0123456789", b" ", b"\n", b"\t\r\x0b\x0c"]
    groups += [bytes([c]) for c in b".,!?:;%&*$#@|=\"'-_/"] + [b"()[]{}<>", bytes(range(128, 192)), bytes(range(192, 256))]
    for i, g in enumerate(groups, 1):
        table[list(g)] = i
    return table, len(groups) + 1


_CLASS, _N = _classes()
FEATURES = _N * _N + HASHED
_STEP = 64 * PASSAGE


def passages(text: bytes) -> Iterator[np.ndarray]:
    """One row of features (float32) a passage, over the whole text, some rows at a time."""
    for at in range(0, max(len(text), 1), _STEP):
        yield _encode(text[at : at + _STEP])


def _learned(text: bytes, most: int) -> np.ndarray:
    """Features of up to ``most`` passages, evenly spread."""
    n = max(1, -(-len(text) // PASSAGE))
    if n <= most:
        return np.concatenate(list(passages(text)))
    at = (np.arange(most) * n // most * PASSAGE).tolist()
    return np.concatenate([_encode(text[a : a + PASSAGE]) for a in at])


def _encode(part: bytes) -> np.ndarray:
    n = max(1, -(-len(part) // PASSAGE))
    x = np.zeros((n, FEATURES), np.float32)
    if not part:
        return x
    raw = np.frombuffer(part, np.uint8)
    bag = np.arange(len(raw)) // PASSAGE
    c = _CLASS[raw]
    bigram = bag[1:] * (_N * _N) + c[:-1] * _N + c[1:]
    x[:, : _N * _N] = np.bincount(bigram, minlength=n * _N * _N).reshape(n, -1)
    if len(raw) > 3:
        r = raw.astype(np.uint32)
        h = (r[:-3] | r[1:-2] << np.uint32(8) | r[2:-1] << np.uint32(16) | r[3:] << np.uint32(24)) * np.uint32(0x9E3779B1)
        h = (h >> np.uint32(23)).astype(np.int64)
        x[:, _N * _N :] = np.bincount(bag[3:] * HASHED + h, minlength=n * HASHED).reshape(n, -1)
    x = np.sqrt(x)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-6)


@dataclass
class Model:
    mean: np.ndarray
    spread: np.ndarray
    weights: dict[str, np.ndarray]
    prior: float

    def score(self, text: bytes) -> float:
        if not self.weights:
            return self.prior
        w = self.weights
        most, weight, bag = -np.inf, 0.0, 0.0  # of the attention so far: its maximum, sum, and weighted passages
        for x in passages(text):
            h = np.maximum((x - self.mean) / self.spread @ w["enc"] + w["enc0"], 0)
            a = (np.tanh(h @ w["v"]) * _sigmoid(h @ w["u"])) @ w["a"]
            top = max(most, float(a.max()))
            a = np.exp(a - top)
            fade = np.exp(most - top)
            most, weight, bag = top, weight * fade + a.sum(), bag * fade + a @ h
        return float(_sigmoid(bag / weight @ w["out"] + w["out0"])[0])


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train(bags: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Model:
    """Adam on the logistic loss; each step takes one batch of bags."""
    prior = float(labels.mean()) if len(labels) else 0.5
    if not bags or not 0 < prior < 1:
        return Model(np.zeros(1), np.ones(1), {}, prior)
    every = np.concatenate([b.astype(np.float32) for b in bags])
    mean, spread = every.mean(axis=0), every.std(axis=0) + 0.02
    del every
    rng = np.random.default_rng(seed)
    shape = {"enc": (FEATURES, HIDDEN), "v": (HIDDEN, ATTENTION), "u": (HIDDEN, ATTENTION), "a": (ATTENTION,), "out": (HIDDEN, 1)}
    w = {k: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32) for k, s in shape.items()}
    w |= {"enc0": np.zeros(HIDDEN, np.float32), "out0": np.zeros(1, np.float32)}
    m = {k: np.zeros_like(x) for k, x in w.items()}
    v = {k: np.zeros_like(x) for k, x in w.items()}
    step = 0
    for epoch in range(epochs):
        rate = 0.003 * (1 - epoch / epochs) + 1e-4
        order = rng.permutation(len(bags))
        for at in range(0, len(order), 64):
            pick = order[at : at + 64]
            grad = _gradient(w, [(bags[i].astype(np.float32) - mean) / spread for i in pick], labels[pick])
            step += 1
            for k, g in grad.items():
                g = g + (1e-3 * w[k] if w[k].ndim > 1 else 0)
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                w[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return Model(mean, spread, w, prior)


def _gradient(w: dict, bags: list[np.ndarray], labels: np.ndarray) -> dict:
    x = np.concatenate(bags)
    sizes = np.array([len(b) for b in bags])
    first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    owner = np.repeat(np.arange(len(bags)), sizes)
    z = x @ w["enc"] + w["enc0"]
    h = np.maximum(z, 0)
    t, s = np.tanh(h @ w["v"]), _sigmoid(h @ w["u"])
    e = (t * s) @ w["a"]
    e = np.exp(e - np.maximum.reduceat(e, first)[owner])
    a = e / np.add.reduceat(e, first)[owner]
    bag = np.add.reduceat(a[:, None] * h, first)
    p = _sigmoid(bag @ w["out"] + w["out0"])[:, 0]
    d = (p - labels)[:, None] / len(bags)
    d_bag = (d @ w["out"].T)[owner]
    d_a = (d_bag * h).sum(axis=1)
    d_e = a * (d_a - np.add.reduceat(a * d_a, first)[owner])
    d_ts = d_e[:, None] * w["a"]
    d_t, d_s = d_ts * s * (1 - t * t), d_ts * t * s * (1 - s)
    d_h = a[:, None] * d_bag + d_t @ w["v"].T + d_s @ w["u"].T
    d_z = d_h * (z > 0)
    grad = {"out": bag.T @ d, "out0": d.sum(axis=0), "a": (t * s).T @ d_e, "v": h.T @ d_t, "u": h.T @ d_s}
    return grad | {"enc": x.T @ d_z, "enc0": d_z.sum(axis=0)}


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _bags(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 64):
                batch = whole.slice(at, 64)
                texts = pc.cast(batch.column("text"), pa.binary())
                x = [_learned(t.as_py() or b"", most).astype(np.float16).tobytes() for t in texts]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), pa.array(x, pa.binary())], names=["doc_id", "quality", "bag"])

    return run


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from at most ``sample`` documents of each class, those with the smallest hash of doc_id.

    The sampled ids (2 x ``sample`` at most, times 1.2) are broadcast to pick
    their texts; only encoded passages reach the driver. The classes are sampled
    at different rates, which shifts the learned log odds by a constant: it is
    taken back from the output bias, by counts of all labelled documents.
    """
    labels = labels.where(~held_out() & F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
    labels = labels.groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    known = docs.select("doc_id").join(labels, "doc_id")
    sizes = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return train([], np.array([float(q) for q in sizes]))
    share = F.when(F.col("quality") == 1, min(1.0, 1.2 * sample / sizes[1])).otherwise(min(1.0, 1.2 * sample / sizes[0]))
    picked = labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / 1_000_000 < share)
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    rows = rows.groupBy("doc_id").agg(F.first("quality").alias("quality"), F.min("text").alias("text"))
    rows = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "text").mapInArrow(_bags(LEARNED), "doc_id long, quality int, bag binary").collect()
    seen: dict[int, int] = {}
    kept = []
    for r in sorted(rows, key=lambda r: (r["doc_id"] * 0x9E3779B1 % 2**32, r["doc_id"], bytes(r["bag"]))):
        if seen.setdefault(r["quality"], 0) < sample:
            seen[r["quality"]] += 1
            kept.append(r)
    bags = [np.frombuffer(r["bag"], np.float16).reshape(-1, FEATURES) for r in kept]
    model = train(bags, np.array([r["quality"] for r in kept], np.float32))
    if model.weights:
        model.weights["out0"] += np.float32(np.log(sizes[1] / seen[1]) - np.log(sizes[0] / seen[0]))
    return model


def score(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    model = model or fit(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.cast(batch.column("text"), pa.binary())
            s = np.array([model.score(t.as_py() or b"") for t in texts], np.float64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
