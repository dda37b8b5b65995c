"""Language identification by the nearest centroid.

A text becomes a unit vector of TF-IDF weights over hashed character 1- to
3-grams of its lower-cased letters (runs of anything else count as one space);
document frequencies are those of all labelled documents that may be learned
from. Each language has several centroids, found by spherical k-means over a
bounded sample of them; a text gets the language of the centroid with the
largest cosine, which is its score. A text too far from every centroid is
rejected: below ``REJECT`` times the 1% quantile of such cosines (of all those
documents with ``LONG`` letters or more), scaled down by the square root of the
length for shorter texts.

Defined results: a null text and one without letters give ``und``, score 0 and
are rejected, as is everything where nothing could be learned; an empty table
gives no rows; repeated rows get equal values; a null doc_id is never held out
and never trained on; extra columns are ignored by ``predict`` and kept by
``keep_known``.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 8192
#: Bound on the documents a language is learned from.
SAMPLE = 400
CENTROIDS = 4
REJECT = 0.5
LONG = 200
UNKNOWN = "und"
_STEP = 1 << 18
#: Steps of the cosine in which the quantile is found.
_BINS = 4096


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def _hash(*parts: np.ndarray) -> np.ndarray:
    h = np.full(len(parts[0]), len(parts), np.uint32)
    for p in parts:
        h = (h ^ p) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
    return h % np.uint32(BUCKETS)


def grams(text: str) -> tuple[np.ndarray, int]:
    """Counts by bucket of the whole text, and its number of letters."""
    counts, n, last = np.zeros(BUCKETS, np.int64), 0, np.full(1, 32, np.uint32)
    table = _letters()
    low = text.lower()
    for at in range(0, len(low), _STEP):
        codes = np.frombuffer(low[at : at + _STEP].encode("utf-32-le", "surrogatepass"), np.uint32)
        is_letter = table[codes]
        n += int(is_letter.sum())
        x = np.concatenate((last, np.where(is_letter, codes, np.uint32(32))))
        if at + _STEP >= len(low):
            x = np.concatenate((x, np.full(1, 32, np.uint32)))
        keep = np.ones(len(x), bool)
        keep[1:] = (x[1:] != 32) | (x[:-1] != 32)
        x = x[keep]
        k = len(last)  # what came before is counted already
        for h in (_hash(x[k:]), _hash(x[k - 1 : -1], x[k:]), _hash(x[:-2], x[1:-1], x[2:])):
            counts += np.bincount(h, minlength=BUCKETS)
        last = x[-2:]
    return counts, n


@dataclass
class Model:
    langs: list[str]
    idf: np.ndarray
    centroids: np.ndarray
    lang_of: np.ndarray
    floor: float

    def vector(self, counts: np.ndarray) -> np.ndarray:
        return _weigh(counts, self.idf)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        counts, n = grams(text) if text else (None, 0)
        if not n or not self.langs:
            return UNKNOWN, 0.0, True
        cosine = self.centroids @ self.vector(counts)
        best = int(cosine.argmax())
        score = float(min(max(cosine[best], 0.0), 1.0))
        floor = self.floor * min(1.0, (n / LONG) ** 0.5)
        return self.langs[self.lang_of[best]], score, score < floor


def _weigh(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(counts).astype(np.float32) * idf
    return v / max(float(np.linalg.norm(v)), 1e-12)


def _cluster(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means from a farthest-first start; the same for the same rows."""
    centres = [x.mean(axis=0)]
    for _ in range(1, k):
        centres.append(x[(x @ np.array(centres).T).max(axis=1).argmin()])
    c = np.array(centres, np.float32)
    for _ in range(rounds):
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
        own = (x @ c.T).argmax(axis=1)
        c = np.array([x[own == i].mean(axis=0) if (own == i).any() else c[i] for i in range(k)], np.float32)
    return c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)


def train(rows: list[tuple[str, np.ndarray]], documents: int = 0, df: np.ndarray | None = None, per_language: int = CENTROIDS) -> Model:
    """rows: (language, counts), in an order that does not change between runs; df: of ``documents``, how many have a bucket.

    The model rejects nothing yet.
    """
    langs = sorted({r[0] for r in rows})
    if not rows:
        return Model([], np.zeros(BUCKETS, np.float32), np.zeros((0, BUCKETS), np.float32), np.zeros(0, int), 0.0)
    idf = np.log((1 + documents) / (1 + df)).astype(np.float32) + 1
    centroids, owner = [], []
    for i, lang in enumerate(langs):
        x = np.array([_weigh(r[1], idf) for r in rows if r[0] == lang], np.float32)
        c = _cluster(x, min(per_language, len(x)))
        centroids.append(c)
        owner += [i] * len(c)
    return Model(langs, idf, np.concatenate(centroids), np.array(owner), 0.0)


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a task's texts with letters: their number, and how many have each bucket."""
    n, df = 0, np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for text in batch.column("text").to_pylist():
            counts, letters = grams(text)
            if letters:
                n += 1
                df += counts > 0
    yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([df.tolist()], pa.list_(pa.int64()))], names=["n", "df"])


def _cosines(model: Model):
    """How many long texts of a task have which best cosine, in steps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(_BINS + 1, np.int64)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                counts, letters = grams(text)
                if letters >= LONG:
                    seen[int(_BINS * min(max(float((model.centroids @ model.vector(counts)).max()), 0.0), 1.0))] += 1
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], names=["step", "n"])

    return run


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [grams(t) for t in batch.column("text").to_pylist()]
        where = [np.flatnonzero(c) for c, _ in found]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("place"),
                batch.column("lang"),
                pa.array([w.astype(np.int32).tobytes() for w in where], pa.binary()),
                pa.array([c[w].astype(np.int32).tobytes() for (c, _), w in zip(found, where, strict=True)], pa.binary()),
                pa.array([n for _, n in found], pa.int64()),
            ],
            names=["place", "lang", "bucket", "count", "letters"],
        )


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn centroids from at most ``sample`` documents a language: those with the smallest hash of doc_id.

    Frequencies and the bound for rejection are of all documents that may be
    learned from. The driver gets hashed counts of the sample, a frequency a
    bucket and a count for each step of the cosine.
    """
    known = docs.where(~held_out() & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    known = known.select("lang", "text", F.xxhash64("doc_id").alias("place"))
    share = {r["lang"]: min(1.0, 1.2 * sample / r["n"]) for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not share:
        return train([])
    part = F.create_map(*[F.lit(x) for kv in share.items() for x in kv])
    uniform = F.pmod("place", F.lit(1_000_000)) / 1_000_000
    picked = known.where(uniform < part[F.col("lang")]).mapInArrow(
        _counted, "place long, lang string, bucket binary, count binary, letters long"
    )
    per: dict[str, list] = {}
    for r in sorted(picked.collect(), key=lambda r: (r["lang"], r["place"], r["letters"], bytes(r["count"]))):
        if len(per.setdefault(r["lang"], [])) < sample and r["letters"]:
            counts = np.zeros(BUCKETS, np.int64)
            counts[np.frombuffer(r["bucket"], np.int32)] = np.frombuffer(r["count"], np.int32)
            per[r["lang"]].append((r["lang"], counts))
    each = known.select("text").mapInArrow(_frequencies, "n long, df array<long>")
    each = each.select(F.posexplode(F.concat(F.array("n"), "df"))).groupBy("pos").agg(F.sum("col").alias("n")).collect()
    totals = np.zeros(BUCKETS + 1, np.int64)
    for r in each:
        totals[r["pos"]] = r["n"]
    model = train([r for rows in per.values() for r in rows], int(totals[0]), totals[1:])
    if model.langs:
        steps = known.select("text").mapInArrow(_cosines(model), "step long, n long").groupBy("step").agg(F.sum("n").alias("n")).orderBy("step").collect()
        upto = np.cumsum([r["n"] for r in steps])
        if len(upto):
            model.floor = REJECT * steps[int(np.searchsorted(upto, 0.01 * upto[-1]))]["step"] / _BINS
    return model


def predict(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, rejected."""
    model = model or fit(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores, rejected = zip(*map(model.predict, batch.column("text").to_pylist()), strict=True) if len(batch) else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(langs, pa.string()),
                    pa.array(scores, pa.float64()),
                    pa.array(rejected, pa.bool_()),
                ],
                names=["doc_id", "held_out", "lang_pred", "score", "rejected"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def keep_known(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """The documents that are not rejected, as they are."""
    model = model or fit(docs)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [not model.predict(t)[2] for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
