"""Views of a corpus: author and collection lists, search, detail pages, panels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import present

NO_AUTHOR, NO_SOURCE, SEVERAL = "Auteur Inconnu", "Poèmes sans recueil", "Fichiers multiples"


def _author() -> Column:
    return F.coalesce(F.nullif(F.col("metadata.author"), F.lit("")), F.lit(NO_AUTHOR))


def home_counts(records: DataFrame) -> DataFrame:
    return records.agg(
        F.countDistinct(_author()).alias("authors"),
        F.countDistinct(F.when(present(F.col("collection_page_id")), F.col("collection_page_id"))).alias("collections"),
        F.countDistinct("page_id").alias("poems"),
    )


def collection_index(records: DataFrame) -> DataFrame:
    """collection_page_id, title and author of its first poem, poem_count."""
    inside = records.where(present(F.col("collection_page_id")))
    return inside.groupBy("collection_page_id").agg(
        F.min_by("collection_title", "ord").alias("title"), F.min_by(_author(), "ord").alias("author"), F.count(F.lit(1)).alias("poem_count")
    )


def author_index(records: DataFrame) -> DataFrame:
    """author, collection_count (of those linked to any of the author's poems), orphan_count."""
    linked = present(F.col("collection_page_id"))
    return records.groupBy(_author().alias("author")).agg(
        F.countDistinct(F.when(linked, F.col("collection_page_id"))).alias("collection_count"), F.count_if(~linked).alias("orphan_count")
    )


def author_list(records: DataFrame) -> DataFrame:
    """author, collection_count, poem_count: all poems of every linked collection, and the author's orphans."""
    sizes = collection_index(records).select("collection_page_id", F.col("poem_count").alias("_size"))
    links = records.where(present(F.col("collection_page_id"))).select(_author().alias("author"), "collection_page_id").distinct()
    inside = links.join(sizes, "collection_page_id").groupBy("author").agg(F.sum("_size").alias("_inside"))
    joined = author_index(records).join(inside, "author", "left")
    return joined.select("author", "collection_count", (F.coalesce("_inside", F.lit(0)) + F.col("orphan_count")).alias("poem_count"))


def matches(column: Column, query: str) -> Column:
    return F.lower(F.coalesce(column, F.lit(""))).contains(query.lower())


def search(frame: DataFrame, column: str, query: str = "", descending: bool = False, locale: str = "fr") -> DataFrame:
    """Rows whose column holds the query, sorted as the locale sorts; null sorts as empty."""
    key = F.collate(F.coalesce(F.col(column), F.lit("")), locale)
    return frame.where(matches(F.col(column), query)).orderBy(key.desc() if descending else key.asc())


def list_places(frame: DataFrame, by: Column, *ties: str, descending: bool = False) -> DataFrame:
    """Adds place (from 0) in the list sorted by ``by``: text as French sorts it, null as empty; numbers as they are.

    A list view shows one page of all rows, so its places come from one total order (a window over all rows).
    """
    order = by.desc() if descending else by.asc()
    return frame.withColumn("place", F.row_number().over(Window.orderBy(order, *ties)) - 1)


def locale_key(column: str, locale: str = "fr") -> Column:
    return F.collate(F.coalesce(F.col(column), F.lit("")), locale)


def author_sort_list(records: DataFrame, by: str = "author", descending: bool = False) -> DataFrame:
    """author, collection_count, orphan_count, place; ``poemCount`` sorts by collections plus orphans, unlike the count shown."""
    rows = author_index(records)
    key = {"author": locale_key("author"), "collectionCount": F.col("collection_count"), "poemCount": F.col("collection_count") + F.col("orphan_count")}[by]
    return list_places(rows, key, "author", descending=descending)


def author_choices(records: DataFrame) -> DataFrame:
    """author, place: the dropdown's order."""
    return list_places(records.select(_author().alias("author")).distinct(), locale_key("author"), "author")


def panel_places(records: DataFrame) -> DataFrame:
    """author, panel, page_id, ord, title, place: each author's panels in order, titles in order inside a panel."""
    shown = panels(records).withColumnRenamed("place", "_kind")
    inside = Window.partitionBy("author").orderBy("_kind", locale_key("panel"), locale_key("title"), "ord")
    return shown.withColumn("place", F.row_number().over(inside) - 1).drop("_kind")


def diff_places(diff: DataFrame, titles: DataFrame) -> DataFrame:
    """page_id, status, title, place: the lists of added, removed and modified pages, each by title. titles: page_id, title."""
    named = diff.where("status != 'same'").select("page_id", "status").join(titles, "page_id", "left")
    same = Window.partitionBy("status").orderBy(locale_key("title"), "page_id")
    return named.withColumn("place", F.row_number().over(same) - 1)


def author_detail(records: DataFrame, author: str) -> DataFrame:
    own = records.where(_author() == author).where(present(F.col("collection_page_id"))).select("collection_page_id").distinct()
    return collection_index(records).join(own, "collection_page_id", "left_semi")


def collection_detail(records: DataFrame, collection_page_id: int) -> DataFrame:
    """Poems of a collection in order; ``header`` where a section begins."""
    order = F.coalesce("poem_order", F.lit(0))
    own = records.where(F.col("collection_page_id") == collection_page_id)
    by_order = Window.partitionBy("collection_page_id").orderBy(order, "ord")
    before = F.lag("section_title").over(by_order)
    first = F.row_number().over(by_order) == 1
    header = F.col("section_title").isNotNull() & (first | ~F.col("section_title").eqNullSafe(before))
    return own.select("page_id", "title", "section_title", order.alias("poem_order"), "ord", header.alias("header")).orderBy("poem_order", "ord")


def poem(records: DataFrame, page_id: int) -> DataFrame:
    return records.where(F.col("page_id") == page_id)


def same_titles(records: DataFrame) -> DataFrame:
    """Records whose title their author has more than once."""
    same = Window.partitionBy(_author(), "title")
    return records.withColumn("title_count", F.count(F.lit(1)).over(same)).where("title_count > 1")


def panels(records: DataFrame) -> DataFrame:
    """author, panel, place, page_id, title: groups by source collection, and all repeated titles once more first."""
    source = F.coalesce(F.nullif(F.col("metadata.source_collection"), F.lit("")), F.lit(NO_SOURCE))
    shown = [_author().alias("author"), "page_id", "ord", "title"]
    grouped = records.select(*shown, source.alias("panel"))
    several = same_titles(records).select(*shown, F.lit(SEVERAL).alias("panel"))
    place = F.when(F.col("panel") == SEVERAL, 0).when(F.col("panel") == NO_SOURCE, 2).otherwise(1)
    return grouped.unionByName(several).withColumn("place", place)


def grouped_by_source(records: DataFrame) -> DataFrame:
    source = F.coalesce(F.nullif(F.col("metadata.source_collection"), F.lit("")), F.lit(NO_SOURCE))
    return records.groupBy(_author().alias("author"), source.alias("panel")).agg(
        F.count(F.lit(1)).alias("poem_count"), F.countDistinct("title").alias("titles")
    )
