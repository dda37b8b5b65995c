"""Exact dedup by skew-safe combining.

Equal texts are found by full comparison at every stage, never by digest
alone; the 64-bit digest only spreads the work:

1. local: each task combines its own rows per text before anything moves;
2. salted: the task winners of a digest meet in ``salts`` separate groups, so
   a text held by a third of all rows never lands in one task;
3. global: at most ``salts`` winners a text are combined.

All three are hash or sort aggregations with the text itself among the
grouping keys. Spark plans stage 1 as the map side of stage 2.

Defined results: null text counts as empty; an empty table gives no rows; rows
with a null doc_id lose against any other; rows that repeat both doc_id and
text are one document (``exact_dedup`` keeps one row, ``exact_groups`` reports
each row with the same values; of their other columns those that are last in
order stay, maps and other types without order compared as text); extra columns
are carried by ``exact_dedup`` for the row that stays and ignored by
``exact_groups``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut_lineage, whole_text

SALTS = 32


def _combined(rows: DataFrame, aggs: list, again: list, salts: int) -> DataFrame:
    """rows: ``_digest, _text`` and what ``aggs`` reads. ``again`` merges what ``aggs`` made."""
    salted = rows.withColumn("_salt", F.spark_partition_id() % salts)
    local = salted.groupBy("_digest", "_salt", "_text").agg(*aggs)
    return local.groupBy("_digest", "_text").agg(*again)


def exact_groups(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Row-level values are attached by (64-bit digest, SHA-256, length); the
    table of groups is checked to hold that key once, since its rows were told
    apart by full text, and the query fails rather than merge two texts.
    """
    docs = docs.select(F.col("doc_id"), whole_text().alias("_text"))
    key = [F.xxhash64("_text").alias("_digest"), F.unhex(F.sha2("_text", 256)).alias("_sha"), F.octet_length("_text").alias("_len")]
    groups = _combined(
        docs.select("doc_id", "_text", key[0]),
        [F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")],
        [F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")],
        salts,
    )
    groups = groups.select(*key, "keep_id", "group_size")
    groups = groups.groupBy("_digest", "_sha", "_len").agg(
        F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"), F.count(F.lit(1)).alias("_texts")
    )
    groups = groups.withColumn(
        "group_size", F.when(F.col("_texts") > 1, F.raise_error(F.lit("two texts share all digests"))).otherwise(F.col("group_size"))
    )
    # cut here, which also runs the guard above whatever columns a caller uses, and so that both sides of the join are plain exchanges and a hot group can be split
    groups = cut_lineage(groups.drop("_texts"))
    rows = docs.select("doc_id", *key)
    return rows.join(groups, ["_digest", "_sha", "_len"]).select(
        "doc_id",
        "keep_id",
        F.col("group_size").cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
    )


def _ordered(kind: T.DataType) -> bool:
    """Whether values of this type can be compared."""
    if isinstance(kind, T.ArrayType):
        return _ordered(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_ordered(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))


def exact_dedup(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """The documents that stay, with all their columns: per text the row with the largest doc_id.

    The winner's other columns travel inside the aggregated struct, so no join
    brings the texts back.
    """
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    best = F.struct(F.col("doc_id"), F.col("text").isNotNull().alias("_given"), *[F.col(f"`{c}`") for c in rest])
    rows = docs.select(F.xxhash64(whole_text()).alias("_digest"), whole_text().alias("_text"), best.alias("_best"))
    odd = [c for c in rest if not _ordered(docs.schema[c].dataType)]
    if odd:
        order = [F.col("doc_id"), F.col("text").isNotNull(), *[F.col(f"`{c}`").cast("string") if c in odd else F.col(f"`{c}`") for c in rest]]
        rows = docs.select(F.xxhash64(whole_text()).alias("_digest"), whole_text().alias("_text"), best.alias("_best"), F.struct(*order).alias("_order"))
        last = [F.max_by("_best", "_order").alias("_best"), F.max("_order").alias("_order")]
    else:
        last = [F.max("_best").alias("_best")]
    won = _combined(rows, last, last, salts)
    return won.select(
        *[
            F.when(F.col("_best._given"), F.col("_text")).alias("text") if c == "text" else F.col(f"_best.`{c}`").alias(c)
            for c in docs.columns
        ]
    )
