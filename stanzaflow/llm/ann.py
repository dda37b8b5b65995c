"""Approximate nearest neighbours by largest inner product: collision-counting hashing.

Query-aware hashing (Huang et al., "Query-Aware Locality-Sensitive Hashing for
Approximate Nearest Neighbor Search", 2015): each of the lines has the vectors of
a shard as one sorted array of projections. A query's window on a line is centred
on its own projection and widened round by round (virtual rehashing); a vector
that lies in enough windows collides often enough to be verified with its true
inner product. Inner product becomes distance by one more coordinate that gives
all vectors of a shard the same length.

The lines are the axes of ``BASES`` random rotations, which tell more of the
distance than lines drawn one by one. Each sorted array is cut into ``CUTS``
stretches, and a bitmap at each cut says which vectors come before it: a window
is the difference of two bitmaps, and the collisions of 64 vectors at a time are
counted by bitwise adders.

Rows are dealt into shards by a hash of vec_id, each vector to one shard, and
queries go to every shard: a task builds the index of its shard once and reads
the queries as a stream. The answers of the shards are merged by rank. The stated
query set meets all rows in blocks; nothing is collected or broadcast, and a
shard's memory does not grow with the table.

Defined results: vectors that are null, empty, zero, or hold null or non-finite
components take no part; vectors of different lengths are not compared; an
empty table gives no rows; rows that repeat vec_id and vector are one; rows that
repeat a vec_id with another vector each ask and answer, never their own id;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

NEAREST = 20
QUERIES = 20
BASES = 2
CUTS = 32
#: A vector is verified once it lies in so large a part of the windows.
COLLIDE = 0.85
#: Widths of the windows by round, in standard deviations of the projections.
WIDTHS = tuple(0.1 * r for r in range(1, 61))
#: A query's rounds end once so many vectors are verified: part of the shard, and so many times the answers.
VERIFY, TIMES = 0.04, 8
SHARD = 16384
#: Bytes of windows that are counted together.
_WORK = 4 << 20


def _sums(x: np.ndarray) -> list[np.ndarray]:
    """x: bitmaps. Their sum at each bit as binary digits, the lowest first, by carry-save addition."""
    digits = []
    while len(x):
        carries = []
        while len(x) > 2:
            n = len(x) // 3
            a, b, c = x[:n], x[n : 2 * n], x[2 * n : 3 * n]
            either = a ^ b
            carries.append(a & b | either & c)
            x = np.concatenate((either ^ c, x[3 * n :]))
        if len(x) == 2:
            carries.append((x[0] & x[1])[None])
            x = (x[0] ^ x[1])[None]
        digits.append(x[0])
        x = np.concatenate(carries) if carries else x[:0]
    return digits


def _at_least(digits: list[np.ndarray], least: int) -> np.ndarray:
    """Bitmap of the sums that reach ``least``."""
    above, same = np.zeros_like(digits[0]), ~np.zeros_like(digits[0])
    for i in range(max(len(digits), least.bit_length()) - 1, -1, -1):
        d = digits[i] if i < len(digits) else np.zeros_like(above)
        if least >> i & 1:
            same &= d
        else:
            above |= same & d
            same &= ~d
    return above | same


class Index:
    """One shard: projections sorted by line, kept as bitmaps of what comes before each cut."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, seed: int = 11):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        n, size = vectors.shape
        squares = (self.vectors * self.vectors).sum(axis=1)
        self.longest = squares.max()
        rng = np.random.default_rng(seed)
        lines = np.hstack([np.linalg.qr(rng.standard_normal((size + 1, size + 1)))[0] for _ in range(BASES)])
        projected = (np.column_stack((self.vectors, np.sqrt(np.maximum(self.longest - squares, 0)))) @ lines).T.copy()
        self.lines = lines[:-1]
        self.spread = projected.std(axis=1) + 1e-12
        places = np.argsort(projected, axis=1, kind="stable")
        # a place is nearest to cut k from here on
        half = np.minimum(((np.arange(1, CUTS + 1) - 0.5) * n / CUTS).astype(np.int64), n - 1)
        self.from_ = np.take_along_axis(projected, places[:, half], axis=1)
        cut = np.empty(projected.shape, np.uint8)
        np.put_along_axis(cut, places, (np.arange(n) * CUTS // n).astype(np.uint8)[None], axis=1)
        words = -(-n // 64)
        self.before = np.zeros((len(cut), CUTS + 1, words * 8), np.uint8)
        for k in range(1, CUTS + 1):
            self.before[:, k, : -(-n // 8)] = np.packbits(cut < k, axis=1, bitorder="little")
        self.before = self.before.view(np.uint64)

    def colliding(self, at: np.ndarray, width: np.ndarray) -> np.ndarray:
        """at: projections (line, query). Bitmaps of the vectors that lie in enough windows."""
        lines = np.arange(len(at))[:, None]
        reach = width * self.spread[:, None]
        low, high = ((self.from_[:, :, None] <= x[:, None]).sum(axis=1) for x in (at - reach, at + reach))
        return _at_least(_sums(self.before[lines, low] ^ self.before[lines, high]), int(np.ceil(COLLIDE * len(at))))

    def candidates(self, queries: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray]]:
        """Each query and the vectors to verify for it, in no order. The query is scaled to the length all vectors have."""
        n = len(self.ids)
        enough = min(n, max(TIMES * (k + 1), int(np.ceil(VERIFY * n))))
        norms = np.sqrt((queries * queries).sum(axis=1, keepdims=True))
        at = (queries / norms * np.sqrt(self.longest)) @ self.lines
        widths, last = np.array(WIDTHS), len(WIDTHS) - 1
        step = max(1, _WORK // (self.before.shape[0] * self.before.shape[2] * 8))
        usual = last // 3
        for first in range(0, len(queries), step):
            some = np.arange(first, min(first + step, len(queries)))
            # windows only widen, so the end can be looked for from any round
            low, high = np.full(len(some), -1), np.full(len(some), last)
            rounds = np.full(len(some), usual)
            found: dict[int, np.ndarray] = {}
            left, stride = np.arange(len(some)), 1
            while len(left):
                stride *= 2
                maps = self.colliding(at[some[left]].T, widths[rounds[left]])
                met = np.bitwise_count(maps).sum(axis=1)
                full = (met >= enough) | (rounds[left] == last)
                found |= {i: maps[x] for x, i in enumerate(left.tolist()) if full[x]}
                high[left[full]], low[left[~full]] = rounds[left[full]], rounds[left[~full]]
                left = left[(high[left] - low[left] > 1) & ~(full & (met <= 3 * enough))]
                a, b = low[left], high[left]
                rounds[left] = np.clip(np.where(a < 0, b - stride, np.where(b == last, a + stride, (a + b) // 2)), a + 1, b - 1)
            usual = int(np.median(high))
            for i in range(len(some)):
                if i in found and np.bitwise_count(found[i]).sum() >= enough:
                    yield first + i, np.flatnonzero(np.unpackbits(found[i].view(np.uint8), count=n, bitorder="little"))
                else:
                    yield first + i, np.arange(n)

    def search(self, ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of the query, vec_id and score of up to ``k`` answers each."""
        of, best, scores = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        for q, near in self.candidates(queries, k):
            near = near[self.ids[near] != ids[q]]
            score = (self.vectors[near] * queries[q]).sum(axis=1)
            if len(near) > k:  # all that tie with the k-th stay in for the order by id
                keep = score >= np.partition(score, len(score) - k)[len(score) - k]
                near, score = near[keep], score[keep]
            top = np.lexsort((self.ids[near], -score))[:k]
            of.append(np.full(len(top), q))
            best.append(self.ids[near[top]])
            scores.append(score[top])
        return np.concatenate(of), np.concatenate(best), np.concatenate(scores)


_ANSWER = "query_id long, mark long, vec_id long, score double"


def _answers(k: int):
    """Rows sorted by shard, vectors before queries. A shard's index is built once; queries come batch by batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, index = None, [], None
        for batch in batches:
            keys = np.column_stack([batch.column(c).to_numpy() for c in ("size", "shard", "asks")])
            runs = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]).any(axis=1)))) if len(keys) else []
            for a, b in zip(runs, [*runs[1:], len(keys)], strict=True):
                size, number, asks = keys[a].tolist()
                if shard != (size, number):
                    shard, held, index = (size, number), [], None
                part = batch.slice(a, b - a)
                ids = part.column("vec_id").to_numpy()
                vectors = part.column("vec").flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
                if not asks:
                    held.append((ids, vectors))
                    continue
                if held:
                    index = Index(*(np.concatenate(x) for x in zip(*held, strict=True)))
                    held = []
                if index:
                    of, best, scores = index.search(ids, vectors, k)
                    marks = part.column("mark").to_numpy()
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (ids[of], marks[of], best, scores)], names=["query_id", "mark", "vec_id", "score"])

    return run


def nearest(vectors: DataFrame, query=None, k: int = NEAREST, shard: int = SHARD) -> DataFrame:
    """Columns query_id, rank, vec_id, score: for each query row its ``k`` nearest other rows.

    ``query`` is a condition on vec_id; by default vec_id is divisible by 20.
    """
    query = F.col("vec_id") % QUERIES == 0 if query is None else query
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & finite & F.exists("vec", lambda x: x != 0))
    shards = max(1, -(-rows.count() // shard))
    rows = rows.dropDuplicates(["vec_id", "vec"]).select("vec_id", "vec", F.size("vec").alias("size"), F.xxhash64("vec").alias("mark"))
    every = F.sequence(F.lit(0), F.lit(shards - 1))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")).withColumn("asks", F.lit(0))
    asked = rows.where(query).withColumn("shard", F.explode(every)).withColumn("asks", F.lit(1))
    both = dealt.unionByName(asked).repartition(shards, "size", "shard").sortWithinPartitions("size", "shard", "asks")
    found = both.mapInArrow(_answers(k), _ANSWER)
    ranked = Window.partitionBy("query_id", "mark").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
