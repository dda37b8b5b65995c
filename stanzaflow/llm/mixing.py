"""Mixing sources to target weights.

Every document gets a hash-random key, and the rows (id, source, size, key; no
texts) are range-sorted by source and key. The sorted partitions are the blocks
whose token sums, by source, are combined into prefix sums: their bounds follow
the data, so a source of a third of all rows has a third of them. A source's
exact budget lies in one partition, of which alone running sums are taken, and
one key inside it is the cut: documents before it are taken,
those after it not, the one on it gives its first words up to the budget. Whole
epochs come before the cut epoch. So a row's decision needs only its own key and
one small row of its source: no text moves and no source gathers in one task.

Defined results: null text has 0 words; null is a source of its own, last in
order; an empty table gives no rows; a source without words gets target 0 and
takes nothing; rows that repeat a doc_id share a key and, if the cut falls on
them, share the rest of the budget in proportion to size, rounded down. Extra
columns are kept by ``mix_documents`` and ignored by ``mix_plan``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, whole_text, word_count

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_EPOCHS = 2
SEED = "mix"
#: Up to so many sources the plan (one row of some 100 bytes each) is broadcast; beyond, it is joined by source.
FEW_SOURCES = 100_000


def mix_key(seed: str = SEED) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def targets(sources: DataFrame, weights=WEIGHTS, share=SHARE, epochs=MAX_EPOCHS) -> DataFrame:
    """sources: one row each with source, source_size. Adds target.

    Weights repeat over the sources in code point order, null last. Sources are
    filled by rising cap per weight: one is capped if its share of what the
    capped ones before it left is above ``epochs`` times its size. That is the
    fixed point of handing on the excess by weight, in closed form. The windows
    run over one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_fill = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    all_rows = Window.partitionBy()
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    t = sources.withColumn("place", F.row_number().over(by_name) - 1).withColumn("weight", w)
    t = t.withColumn("cap", F.col("source_size") * F.lit(float(epochs)))
    t = t.withColumn("total", F.sum("source_size").over(all_rows) * F.lit(float(share)))
    t = t.withColumn("before", F.coalesce(F.sum("cap").over(by_fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    t = t.withColumn("weights", F.sum("weight").over(by_fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    t = t.withColumn("capped", (F.col("total") - F.col("before")) * F.col("weight") > F.col("cap") * F.col("weights"))
    t = t.withColumn("left", F.col("total") - F.min(F.when(~F.col("capped"), F.col("before"))).over(all_rows))
    t = t.withColumn("open", F.max(F.when(~F.col("capped"), F.col("weights"))).over(all_rows))
    target = F.when(F.col("capped"), F.col("cap")).otherwise(F.col("left") * F.col("weight") / F.col("open"))
    return t.select("source", "source_size", target.alias("target"))


def _few(plan: DataFrame, sources: int) -> DataFrame:
    return F.broadcast(plan) if sources <= FEW_SOURCES else plan


def _cuts(sized: DataFrame, **how) -> tuple[DataFrame, int]:
    """The number of sources, and per source: its sizes, whole epochs, the key of the cut and what the cut's rows give."""
    ranges = sized.groupBy("source", "range").agg(F.sum("size").alias("words"))
    ranges = ranges.withColumn("upto", F.sum("words").over(Window.partitionBy("source").orderBy("range")))
    ranges = ranges.withColumn("source_size", F.sum("words").over(Window.partitionBy("source")))
    ranges = cut_lineage(ranges)
    plan = targets(ranges.groupBy("source").agg(F.max("source_size").alias("source_size")), **how)
    size = F.col("source_size")
    plan = plan.withColumn("budget", F.floor("target").cast("long"))
    plan = plan.withColumn("epochs", F.when(size > 0, F.expr("budget div nullif(source_size, 0)")).otherwise(0).cast("long"))
    plan = cut_lineage(plan.withColumn("rest", F.col("budget") - F.col("epochs") * size))
    sources = plan.count()
    r, p = ranges.alias("r"), plan.alias("p")
    hit = r.join(
        _few(p, sources),
        F.col("r.source").eqNullSafe(F.col("p.source"))
        & (F.col("r.upto") - F.col("r.words") < F.col("p.rest"))
        & (F.col("r.upto") >= F.col("p.rest")),
    ).select("r.source", "r.range", (F.col("p.rest") - F.col("r.upto") + F.col("r.words")).alias("rest"))
    # only the rows of the one sorted partition a source that holds the cut
    inside = sized.alias("s").join(
        _few(hit.alias("h"), sources), F.col("s.source").eqNullSafe(F.col("h.source")) & (F.col("s.range") == F.col("h.range"))
    )
    inside = inside.groupBy("s.source", "key", "rest").agg(F.sum("size").alias("block"))
    inside = inside.withColumn("upto", F.sum("block").over(Window.partitionBy("source").orderBy("key")))
    cut = inside.where((F.col("upto") >= F.col("rest")) & (F.col("upto") - F.col("block") < F.col("rest")))
    cut = cut.select("source", F.col("key").alias("cut"), "block", (F.col("rest") - F.col("upto") + F.col("block")).alias("part"))
    c = cut.alias("c")
    plan = p.join(c, F.col("p.source").eqNullSafe(F.col("c.source")), "left").select(
        "p.source", "source_size", "target", "epochs", "cut", "block", "part"
    )
    return cut_lineage(plan), sources


def _taken() -> Column:
    last = (
        F.when(F.col("key") < F.col("cut"), F.col("size"))
        .when(F.col("key") == F.col("cut"), F.expr("part * size div nullif(block, 0)"))
        .otherwise(F.lit(0))
    )
    return (F.col("epochs") * F.col("size") + F.coalesce(last, F.lit(0))).cast("long")


def _with_plan(rows: DataFrame, plan: DataFrame, sources: int) -> DataFrame:
    plan = _few(plan.withColumnRenamed("source", "_source"), sources)
    return rows.join(plan, F.col("source").eqNullSafe(F.col("_source"))).withColumn("taken", _taken())


def _sized(docs: DataFrame, seed: str) -> DataFrame:
    """Range-sorted by source and key; ``range`` is the number of the sorted partition. Saved, since bounds are sampled."""
    rows = docs.select("doc_id", "source", word_count(whole_text()).alias("size"), mix_key(seed).alias("key"))
    rows = cut_lineage(rows).repartitionByRange("source", "key").sortWithinPartitions("source", "key")
    return cut_lineage(rows.withColumn("range", F.spark_partition_id()))


def mix_plan(docs: DataFrame, seed: str = SEED, **how) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (words, repeats counted)."""
    sized = _sized(docs, seed)
    return _with_plan(sized, *_cuts(sized, **how)).select("doc_id", "size", "source_size", "target", "taken")


def mix_documents(docs: DataFrame, seed: str = SEED, **how) -> DataFrame:
    """The mix itself with the columns of ``docs``: a row for each epoch of a document that is taken.

    The document on a source's cut also gives a row with its first words up to
    the budget, whitespace between them kept. Documents without words are never
    taken.
    """
    plan, sources = _cuts(_sized(docs, seed), **how)
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), "doc_id", "source")
    inner = inner.withColumn("size", word_count(F.col("_doc.text"))).withColumn("key", mix_key(seed))
    rows = _with_plan(inner, plan, sources).where(F.col("taken") > 0)
    whole = F.expr("taken div size").cast("int")
    rest = (F.col("taken") % F.col("size")).cast("int")
    rows = rows.withColumn("_rest", rest)
    words = F.explode(F.concat(F.array_repeat(F.lit(0), whole), F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<int>"))))
    rows = rows.withColumn("_first", words)
    # each piece is a word with the whitespace before it
    pieces = F.split(F.col("_doc.text"), r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    head = F.array_join(F.slice(pieces, 1, F.greatest(F.col("_first"), F.lit(1))), "")
    text = F.when(F.col("_first") > 0, head).otherwise(F.col("_doc.text"))
    return rows.select(*[text.alias("text") if c == "text" else F.col(f"_doc.`{c}`").alias(c) for c in docs.columns])
