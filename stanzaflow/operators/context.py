"""Ordered collections and title lookups.

``items``: collection_id, pos, title, kind (POEM or SECTION_TITLE), and optionally
resolved (whether the title led to a page).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import spaced



def _ordered():
    return Window.partitionBy("collection_id").orderBy("pos")


def carry_sections(items: DataFrame) -> DataFrame:
    """Poems with the last section title before them."""
    section = F.last(F.when(F.col("kind") == "SECTION_TITLE", F.col("title")), ignorenulls=True)
    before = section.over(_ordered().rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return items.withColumn("section_title", before).where(F.col("kind") == "POEM")


def numbered(poems: DataFrame) -> DataFrame:
    """poem_order from 0 over the resolved poems (all, without that column); the first one carries the collection."""
    if "resolved" in poems.columns:
        poems = poems.where("resolved").drop("resolved")
    out = poems.withColumn("poem_order", (F.row_number().over(_ordered()) - 1).cast("int"))
    return out.withColumn("is_first_poem", F.col("poem_order") == 0)


def header_breaks(poems: DataFrame) -> DataFrame:
    """A header is shown for order 0 and where the section differs from that of the poem before."""
    by_order = Window.partitionBy("collection_id").orderBy("poem_order")
    changed = ~F.col("section_title").eqNullSafe(F.lag("section_title").over(by_order))
    return poems.withColumn("header", (F.col("poem_order") == 0) | changed)


def first_by_title(items: DataFrame) -> DataFrame:
    """Of items with one title in a collection, the first; order is kept by pos."""
    same = Window.partitionBy("collection_id", "title").orderBy("pos")
    return items.withColumn("_n", F.row_number().over(same)).where("_n = 1").drop("_n")


def title_ids(pages: DataFrame, namespace: int = 0) -> DataFrame:
    """title (with spaces), page_id: the largest id where a title repeats."""
    own = pages.where(F.col("namespace") == namespace)
    return own.groupBy(spaced(F.col("title")).alias("title")).agg(F.max("page_id").alias("page_id"))


def resolve(frame: DataFrame, ids: DataFrame, title: str = "title") -> DataFrame:
    """Adds page_id by title, underscores or spaces; null where unknown."""
    keyed = ids.select(F.col("title").alias("_key"), "page_id")
    return frame.join(keyed, spaced(F.col(title)) == F.col("_key"), "left").drop("_key")


def attach(poems: DataFrame, context: DataFrame, wikitext: DataFrame) -> DataFrame:
    """Poems with their context (may be missing) and wikitext (empty where missing), by page_id."""
    out = poems.join(context, "page_id", "left").join(wikitext, "page_id", "left")
    return out.withColumn("wikitext", F.coalesce("wikitext", F.lit("")))


def with_categories(pages: DataFrame, links: DataFrame, targets: DataFrame) -> DataFrame:
    """Adds categories (titles with spaces, distinct): links page_id, target_id; targets target_id, namespace, title."""
    named = links.join(targets.where(F.col("namespace") == 14), "target_id")
    sets = named.groupBy("page_id").agg(F.sort_array(F.collect_set(spaced(F.col("title")))).alias("categories"))
    out = pages.join(sets, "page_id", "left")
    return out.withColumn("categories", F.coalesce("categories", F.array().cast("array<string>")))


def without(ids: DataFrame, done: DataFrame) -> DataFrame:
    """Ids not yet done (resume), each once."""
    return ids.select("page_id").distinct().join(done.select("page_id"), "page_id", "left_anti")


def infer_parent(poems: DataFrame, collections: DataFrame) -> DataFrame:
    """parent_id: the collection whose title is the first path segment of the poem's title; of several, the largest id."""
    parents = collections.groupBy(F.col("title").alias("_parent")).agg(F.max("page_id").alias("parent_id"))
    first = F.when(F.col("title").contains("/"), F.element_at(F.split("title", "/"), 1))
    return poems.join(parents, first == F.col("_parent"), "left").drop("_parent")


def upward(records: DataFrame, ids: DataFrame, done: DataFrame) -> DataFrame:
    """page_id of the collections that poems without one name in their metadata, and that are not done yet."""
    lacking = records.where(F.col("collection_page_id").isNull() & (F.col("metadata.source_collection") != ""))
    named = lacking.select(F.col("metadata.source_collection").alias("title")).distinct()
    return without(resolve(named, ids).where("page_id is not null"), done)


def follow(frame: DataFrame, redirects: DataFrame) -> DataFrame:
    """page_id led over redirects (source, resolved); ids that are no redirect stay, and those that lead nowhere become null."""
    ahead = redirects.select(F.col("source").alias("_source"), F.col("resolved").alias("_resolved"))
    out = frame.join(ahead, F.col("page_id") == F.col("_source"), "left")
    return out.withColumn("page_id", F.when(F.col("_source").isNull(), F.col("page_id")).otherwise(F.col("_resolved"))).drop("_source", "_resolved")


def pending(found: DataFrame, seen: DataFrame) -> DataFrame:
    """Feedback rows (page_id, has_context) that still have work to do: not seen, or seen without the context they bring."""
    best = found.groupBy("page_id").agg(F.max("has_context").alias("has_context"))
    known = seen.groupBy("page_id").agg(F.max("has_context").alias("_had"))
    out = best.join(known, "page_id", "left")
    return out.where(F.col("_had").isNull() | (F.col("has_context") & ~F.col("_had"))).drop("_had")


def child_counts(items: DataFrame) -> DataFrame:
    """collection_id, poems, sections: what each collection lists."""
    return items.groupBy("collection_id").agg(F.count_if(F.col("kind") == "POEM").alias("poems"), F.count_if(F.col("kind") == "SECTION_TITLE").alias("sections"))


def build(items: DataFrame, ids: DataFrame, pending: DataFrame) -> DataFrame:
    """page_id, collection_id, section_title, poem_order, is_first_poem of pending poems that collections list.

    A poem in several collections gets the one with the largest id.
    """
    found = resolve(carry_sections(items), ids).where(F.col("page_id").isNotNull())
    found = numbered(found.join(pending.select("page_id"), "page_id", "left_semi"))
    ranked = Window.partitionBy("page_id").orderBy(F.desc("collection_id"), "pos")
    out = found.withColumn("_n", F.row_number().over(ranked)).where("_n = 1")
    return out.select("page_id", "collection_id", "section_title", "poem_order", "is_first_poem")


def structures(items: DataFrame, ids: DataFrame) -> DataFrame:
    """collection_id, content: ordered list of poems and sections with their poems."""
    placed = resolve(items, ids).withColumn("_section", F.count_if(F.col("kind") == "SECTION_TITLE").over(_ordered()))
    info = F.struct("pos", "title", "page_id")
    parts = placed.groupBy("collection_id", "_section").agg(
        F.min_by("title", "pos").alias("_title"),
        F.min_by("kind", "pos").alias("_kind"),
        F.sort_array(F.collect_list(F.when(F.col("kind") == "POEM", info))).alias("poems"),
    )
    plain = F.col("_kind") == "POEM"  # what stands before the first section
    entry = F.struct(F.col("_section").alias("place"), F.when(~plain, F.col("_title")).alias("section_title"), F.col("poems"))
    return parts.groupBy("collection_id").agg(F.sort_array(F.collect_list(entry)).alias("content"))
