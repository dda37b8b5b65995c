"""SimHash near-dedup with pigeonhole blocks.

A 64-bit fingerprint is cut into four blocks of 16 bits. Fingerprints that
differ in at most two bits agree in two of the four, so they meet under one of
six 32-bit keys; pairs that meet are verified by Hamming distance. Only distinct
fingerprints take part, so copies cost nothing.

A key under which more than ``BUCKET`` fingerprints meet is not paired up: each
of its fingerprints is listed under itself and its 32 neighbours by one bit
outside the key, and those that share a neighbour are linked. Two fingerprints
share one exactly if they differ in at most two bits, a neighbour has at most 33
fingerprints, and the work is linear. So no group is ever paired with itself,
and no link is lost.

Defined results: null and blank texts have fingerprint zero and link as any
other; an empty table gives no rows; repeated rows get equal values; rows with
a null doc_id are reported, but never name a component unless it has no other
id; extra columns are ignored by ``near_groups`` and kept by ``near_dedup``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, whole_text
from .components import connected_components

SHINGLE = 3
DISTANCE = 2
BUCKET = 64
_PAIRS = list(combinations(range(4), 2))
_STEP = 1 << 16
#: Bytes of a text that are in words at a time.
BLOCK = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _blocks(text: bytes) -> Iterator[bytes]:
    """The text in blocks of some ``BLOCK`` bytes, cut before white space."""
    at = 0
    while at < len(text):
        cut = _SPACE.search(text, at + BLOCK)
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Unsigned SimHash of UTF-8 text: bit i is set if it is in over half the shingle hashes. Texts are read block by block."""
    ones, n, words = np.zeros(64, np.int64), 0, []
    hashed = xxhash.xxh64_intdigest
    for block in _blocks(text):
        words += block.lower().split()  # on bytes: A-Z only, and \x20 \x09-\x0D only
        if len(words) < shingle:
            continue
        line = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        first = np.concatenate(([0], ends[:-shingle] + 1)).tolist()
        last = ends[shingle - 1 :].tolist()
        h = np.fromiter((hashed(line[a:b], seed=42) for a, b in zip(first, last, strict=True)), np.uint64, len(first))
        for at in range(0, len(h), _STEP):
            bits = np.unpackbits(h[at : at + _STEP].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int64)
        n += len(h)
        words = words[len(words) - shingle + 1 :]  # the next block's shingles begin in these
    if not n:
        return hashed(b" ".join(words), seed=42) if words else 0
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.cast(batch.column("text"), pa.binary())
            fp = np.fromiter((fingerprint(t.as_py() or b"", shingle) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return rows.mapInArrow(_fingerprints(shingle), "doc_id long, fp long")


def _block(i: int) -> Column:
    return F.shiftrightunsigned("fp", 16 * i).bitwiseAND(F.lit(0xFFFF))


def _key(i: int, j: int) -> Column:
    return F.shiftleft(_block(i), 16).bitwiseOR(_block(j))


def links(distinct: DataFrame) -> DataFrame:
    """distinct: column fp, each value once. Columns a, b: linked fingerprints.

    Pairs from small keys are all there; from crowded keys, enough of them to
    connect what is connected.
    """
    keys = F.explode(F.array(*[F.struct(F.lit(t).alias("t"), _key(i, j).alias("key")) for t, (i, j) in enumerate(_PAIRS)]))
    keyed = distinct.select("fp", keys.alias("k")).select("fp", "k.t", "k.key")
    met = keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("met")).where("met > 1")
    keyed = cut_lineage(keyed.join(met, ["t", "key"]))
    small = keyed.where(F.col("met") <= BUCKET)
    a, b = small.alias("a"), small.alias("b")
    near = (F.col("a.fp") < F.col("b.fp")) & (F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= DISTANCE)
    paired = a.join(b, (F.col("a.t") == F.col("b.t")) & (F.col("a.key") == F.col("b.key")) & near)
    paired = paired.select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))
    flips = F.array(*[F.array(*_flips(i, j)) for i, j in _PAIRS])
    around = keyed.where(F.col("met") > BUCKET).select("t", "fp", F.explode(F.element_at(flips, F.col("t") + 1)).alias("bit"))
    around = around.groupBy("t", F.col("fp").bitwiseXOR(F.col("bit")).alias("near")).agg(F.collect_set("fp").alias("fps"))
    starred = around.where(F.size("fps") > 1).select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a != b")
    return paired.unionByName(starred)


def _flips(i: int, j: int) -> list[Column]:
    """Zero, and every single bit outside blocks i and j."""
    bits = [16 * k + n for k in range(4) if k not in (i, j) for n in range(16)]
    return [F.lit(0).cast("long"), *[F.lit(np.uint64(1 << n).astype(np.int64).item()) for n in bits]]


def components(fps: DataFrame) -> DataFrame:
    """fps: doc_id, fp. One row per fingerprint: fp, component_id."""
    distinct = cut_lineage(fps.groupBy("fp").agg(F.min("doc_id").alias("root")))
    labels = connected_components(links(distinct.select("fp"))).withColumnRenamed("node", "fp")
    labelled = distinct.join(labels, "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    # cut here, so that both sides of the join are plain exchanges and a large component can be split
    roots = cut_lineage(labelled.groupBy("label").agg(F.min("root").alias("component_id")))
    return labelled.join(roots, "label").select("fp", "component_id")


def near_groups(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    fps = cut_lineage(fingerprints(docs))
    rows = fps.join(components(fps), "fp")
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def near_dedup(docs: DataFrame) -> DataFrame:
    """The documents that stay, with their columns: of each component the one with the smallest doc_id.

    Rows that share a doc_id are one document here: they all stay if one does.
    """
    fps = cut_lineage(fingerprints(docs))
    kept = fps.join(components(fps), "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = kept.select("doc_id").distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["doc_id"]), "left_semi")
