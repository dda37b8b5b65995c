"""Profiling: one aggregation per grain, top lists by ordered limit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import present, truthy

TOP = 10


def _n(c: Column, name: str) -> Column:
    return F.coalesce(F.sum(c.cast("long")), F.lit(0).cast("long")).alias(name)


def percent(part: str, whole: str) -> Column:
    return F.round(F.try_divide(F.col(part) * 100.0, F.nullif(F.col(whole), F.lit(0))), 2)


def verses() -> Column:
    each = F.aggregate(F.col("structure.stanzas"), F.lit(0).cast("long"), lambda n, s: n + F.size(s))
    return F.coalesce(each, F.lit(0).cast("long"))


def stanzas() -> Column:
    return F.coalesce(F.size("structure.stanzas").cast("long"), F.lit(0).cast("long"))


def _id() -> Column:
    return F.col("collection_page_id")


def _title() -> Column:
    return F.col("collection_title")


def _author() -> Column:
    return F.col("metadata.author")


def overview(records: DataFrame) -> DataFrame:
    untitled = ~present(_id()) & truthy(_title())
    return records.agg(
        F.count(F.lit(1)).alias("poems"),
        F.countDistinct(F.when(truthy(_author()), _author())).alias("authors"),
        F.countDistinct(F.when(present(_id()), _id())).alias("collections"),
        F.countDistinct(F.when(untitled, _title())).alias("unidentified_titles"),
    )


def completeness(records: DataFrame) -> DataFrame:
    section = truthy(F.col("section_title"))
    out = records.agg(
        F.count(F.lit(1)).alias("poems"),
        *[_n(truthy(F.col(f"metadata.{m}")), f"with_{m}") for m in ("author", "publication_date", "publisher", "translator")],
        _n(present(_id()), "identified"),
        _n(~present(_id()) & truthy(_title()), "unidentified"),
        _n(F.col("poem_order").isNotNull(), "with_order"),
        _n(present(_id()) & section, "with_section"),
        F.countDistinct(F.when(present(_id()) & section, _id())).alias("sectioned_collections"),
        F.countDistinct(F.when(present(_id()), _id())).alias("collections"),
    )
    out = out.withColumn("in_collection", F.col("identified") + F.col("unidentified"))
    shares = {"with_author": "poems", "with_publication_date": "poems", "with_publisher": "poems", "with_translator": "poems"}
    shares |= {"with_order": "in_collection", "with_section": "identified", "sectioned_collections": "collections"}
    for part, whole in shares.items():
        out = out.withColumn(f"{part}_pct", percent(part, whole))
    return out


def structure(records: DataFrame) -> DataFrame:
    sized = records.select(stanzas().alias("s"), verses().alias("v"))
    return sized.agg(
        F.sum("s").alias("stanzas"),
        F.sum("v").alias("verses"),
        F.round(F.avg("s"), 6).alias("stanzas_avg"),
        F.round(F.avg("v"), 6).alias("verses_avg"),
        F.bround(F.median("v"), 0).alias("verses_median"),
        F.max("v").alias("verses_max"),
        F.min("v").alias("verses_min"),
    )


def content(records: DataFrame) -> DataFrame:
    """Copies by checksum, and titles that several collections share."""
    same = records.where(truthy(F.col("checksum_sha256"))).groupBy("checksum_sha256").agg(F.count(F.lit(1)).alias("n"))
    copies = same.agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n") - 1)), F.lit(0)).alias("exact_duplicates"))
    titles = records.where(present(_id()) & truthy(_title())).groupBy("collection_title").agg(F.countDistinct("collection_page_id").alias("ids"))
    shared = titles.where("ids > 1").agg(F.count(F.lit(1)).alias("shared_titles"), F.coalesce(F.sum("ids"), F.lit(0)).alias("collections_affected"))
    return copies.crossJoin(shared)  # one row each


def hubs(records: DataFrame) -> DataFrame:
    """Pages that several records call their hub: version_count (rows), versions (pages), label."""
    title = F.coalesce(F.nullif("hub_title", F.lit("")), F.concat(F.lit("Standalone poem: "), F.coalesce("title", F.lit(""))))
    by_hub = records.where(F.col("hub_page_id").isNotNull()).groupBy("hub_page_id")
    found = by_hub.agg(
        F.count(F.lit(1)).alias("version_count"),
        F.countDistinct("page_id").alias("versions"),
        F.min_by(title, "ord").alias("hub_label"),
        F.min("ord").alias("first_ord"),
    )
    return found.where("version_count > 1")


def versions(records: DataFrame) -> DataFrame:
    return hubs(records).agg(F.count(F.lit(1)).alias("real_hubs"), F.coalesce(F.sum("versions"), F.lit(0)).alias("poems_in_hubs"))


def _top(found: DataFrame, by: str, n: int = TOP) -> DataFrame:
    """Ties in order of first appearance."""
    return found.orderBy(F.desc(by), F.asc("first_ord")).limit(n)


def authors(records: DataFrame) -> DataFrame:
    return (
        records.where(truthy(_author()))
        .groupBy(_author().alias("author"))
        .agg(
            F.count(F.lit(1)).alias("poem_count"),
            F.countDistinct(F.when(present(_id()), _id())).alias("collection_count"),
            F.min("ord").alias("first_ord"),
        )
    )


def collections(records: DataFrame) -> DataFrame:
    return (
        records.where(present(_id()))
        .groupBy("collection_page_id")
        .agg(
            F.count(F.lit(1)).alias("poem_count"),
            F.countDistinct(F.when(truthy(_title()), _title())).alias("title_count"),
            F.countDistinct(F.when(truthy(F.col("section_title")), F.col("section_title"))).alias("section_count"),
            F.countDistinct(F.when(truthy(_author()), _author())).alias("author_count"),
            F.coalesce(F.min(F.when(truthy(_title()), _title())), F.concat(F.lit("ID: "), F.col("collection_page_id").cast("string"))).alias("label"),
            F.min("ord").alias("first_ord"),
        )
    )


def top_authors(records: DataFrame) -> DataFrame:
    return _top(authors(records), "poem_count").select("author", "poem_count")


def top_collections(records: DataFrame) -> DataFrame:
    return _top(collections(records), "poem_count").select("collection_page_id", "label", "poem_count")


def top_sections(records: DataFrame) -> DataFrame:
    return _top(collections(records), "section_count").select("collection_page_id", "label", "section_count")


def top_unidentified(records: DataFrame) -> DataFrame:
    lone = records.where(~present(_id()) & truthy(_title())).groupBy("collection_title")
    return _top(lone.agg(F.count(F.lit(1)).alias("poem_count"), F.min("ord").alias("first_ord")), "poem_count").drop("first_ord")


def top_hubs(records: DataFrame) -> DataFrame:
    return _top(hubs(records), "version_count").select("hub_page_id", "hub_label", "version_count")


def by_length(records: DataFrame, longest: bool = True, n: int = TOP) -> DataFrame:
    sized = records.select("page_id", "title", "ord", verses().alias("verses"))
    return sized.orderBy(F.desc("verses") if longest else F.asc("verses"), F.asc("ord")).limit(n)
