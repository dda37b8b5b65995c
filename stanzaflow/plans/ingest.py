"""Offline ingest: dumps to records, as one plan with a saved table after classification."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema
from ..functions import markup, text
from ..operators import context, graph
from ..operators import records as ops
from ..sources import corpus, dumps
from ..streaming import schedule

BOOKS = "Recueils de poèmes"


@dataclass
class Dumps:
    """Paths (patterns) of the SQL, NDJSON and XML inputs; without redirects, titles are looked up as they are."""

    page: str
    categorylinks: str
    linktarget: str
    html: str
    xml: str
    redirect: str | None = None


def classified(spark: SparkSession, d: Dumps, ids: DataFrame, lang: str, tables: dict) -> DataFrame:
    pages = dumps.read_ndjson(spark, d.html, ids)
    pages = context.with_categories(pages, tables["links"].select("page_id", "target_id"), tables["targets"])
    return markup.classify(pages.withColumn("namespace", F.lit(0)), lang)


def listed_items(pages: DataFrame) -> DataFrame:
    items = pages.select(F.col("page_id").alias("collection_id"), F.posexplode("parsed.items").alias("pos", "i"))
    return items.select("collection_id", "pos", "i.title", "i.kind")


def records(poems: DataFrame, order: DataFrame, hubs: DataFrame, books: DataFrame, wikitext: DataFrame, lang: str) -> DataFrame:
    """Records of the poems. order: output of ``context.build``; hubs: page_id, hub_page_id, hub_title."""
    full = context.attach(poems, order.join(hubs, "page_id", "full_outer"), wikitext.select("page_id", "wikitext"))
    named = books.select(F.col("page_id").alias("collection_id"), F.col("title").alias("book_title"))
    full = full.join(named, "collection_id", "left")
    full = context.infer_parent(full, books.select("page_id", "title"))
    w = markup.wikitext(F.col("wikitext"))
    full = full.withColumn("_w", w).withColumn("_stanzas", markup.stanzas(F.col("parsed")))
    pick = {m: F.nullif(F.col(f"parsed.{m}"), F.lit("")) for m in schema.METADATA}
    both = {m: F.coalesce(pick[m], F.col(f"_w.{m}")) if m in ("author", "publication_date", "source_collection") else pick[m] for m in pick}
    both["author"] = text.clean_author(both["author"])
    both["source_collection"] = text.source_fallback(both["source_collection"], F.col("title"))
    own_title = F.coalesce("book_title", both["source_collection"])
    columns = {
        "page_id": F.col("page_id"),
        "revision_id": F.col("revision_id"),
        "title": F.col("title"),
        "language": F.lit(lang),
        "wikisource_url": text.page_url(F.lit(lang), F.col("title")),
        "collection_page_id": F.coalesce("collection_id", "parent_id"),
        "collection_title": own_title,
        "section_title": F.col("section_title"),
        "poem_order": F.col("poem_order"),
        "hub_title": F.col("hub_title"),
        "hub_page_id": F.coalesce("hub_page_id", "page_id"),
        "metadata": F.struct(*[both[m].alias(m) for m in schema.METADATA]),
        "structure": F.struct(F.col("_stanzas").alias("stanzas"), F.col("parsed.raw_markers").alias("raw_markers")),
        "is_first_poem": F.coalesce("is_first_poem", F.lit(False)),
        "normalized_text": text.joined_stanzas(F.col("_stanzas")),
        "raw_wikitext": F.col("wikitext"),
        "checksum_sha256": text.checksum(F.col("wikitext")),
        "extraction_timestamp": F.current_timestamp(),
        "provenance": F.lit("dump"),
    }
    return full.where(F.size("_stanzas") > 0).select(*[c.alias(k) for k, c in columns.items()])


def with_collections(rows: DataFrame, items: DataFrame, ids: DataFrame, books: DataFrame, lang: str) -> DataFrame:
    """The first poem of a collection carries the collection's whole structure."""
    url = lambda c: text.page_url(F.lit(lang), c)

    def info(p):
        return F.struct(p["title"].alias("title"), p["page_id"].alias("page_id"), url(p["title"]).alias("url"))

    content = context.structures(items, ids)
    kind = schema.COLLECTION.split("content:")[1][:-1]
    as_section = lambda e: F.array(
        F.struct(e["section_title"].alias("title"), F.lit(None).cast("bigint").alias("page_id"), F.lit(None).cast("string").alias("url"), F.transform(e["poems"], info).alias("poems"))
    )
    none = f"array<struct<{schema._INFO}>>"
    as_poems = lambda e: F.transform(
        e["poems"], lambda p: F.struct(p["title"].alias("title"), p["page_id"].alias("page_id"), url(p["title"]).alias("url"), F.lit(None).cast(none).alias("poems"))
    )
    flat = F.flatten(F.transform("content", lambda e: F.when(e["section_title"].isNull(), as_poems(e)).otherwise(as_section(e)))).cast(kind)
    named = content.join(books.select(F.col("page_id").alias("collection_id"), "title"), "collection_id")
    whole = F.struct(
        F.col("collection_id").alias("page_id"), F.col("title"), F.lit(None).cast("string").alias("author"), url(F.col("title")).alias("url"), flat.alias("content")
    )
    whole = named.select("collection_id", whole.alias("_whole"))
    out = rows.join(whole, F.col("is_first_poem") & (F.col("collection_page_id") == F.col("collection_id")), "left")
    out = out.withColumn("collection_structure", F.col("_whole"))
    return out.select(*[c.split()[0] for c in schema.RECORD.split(", ")])


@dataclass
class Result:
    """What an ingest gives; all but the records are small or logs."""

    records: DataFrame
    other: DataFrame
    collections: DataFrame
    hubs: DataFrame
    rejects: DataFrame
    tree: DataFrame
    pages: DataFrame


def _log(pages: DataFrame, lang: str, parents: DataFrame, children: DataFrame | None = None) -> DataFrame:
    """Columns of an audit log. parents: page_id, ParentTitle; children: page_id, ChildCount."""
    rows = pages.join(parents, "page_id", "left")
    columns = [
        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("Timestamp"),
        F.col("title").alias("PageTitle"),
        text.page_url(F.lit(lang), F.col("title")).alias("URL"),
        F.coalesce("ParentTitle", F.lit("")).alias("ParentTitle"),
        F.col("reason").alias("Reason"),
    ]
    if children is not None:
        rows = rows.join(children, "page_id", "left")
        columns.append(F.coalesce("ChildCount", F.lit(0)).alias("ChildCount"))
    return rows.select(*columns)


def ingest(spark: SparkSession, d: Dumps, category: str, lang: str, work: str, done: DataFrame | None = None, limit: int | None = None) -> Result:
    """Records of the category's poems and of what its collections list, sorted by page_id, and the logs.

    Two bounded passes: pages of the category tree, then pages that collections and hubs of pass one name, or that their
    poems name as collection. Titles lead over redirects. ``work`` is a shared folder; each dump is parsed once into it,
    and so are the edges of the category tree and the classified pages.
    """

    def saved(frame: DataFrame, name: str) -> DataFrame:
        frame.write.mode("overwrite").parquet(f"{work}/{name}")
        return spark.read.parquet(f"{work}/{name}")

    paths = {"page": d.page, "categorylinks": d.categorylinks, "linktarget": d.linktarget} | ({"redirect": d.redirect} if d.redirect else {})
    raw = {name: saved(dumps.read_sql(spark, path, name), f"table-{name}") for name, path in paths.items()}
    tables = {"pages": raw["page"], "links": raw["categorylinks"], "targets": raw["linktarget"]}
    edges = saved(graph.category_edges(**tables), "edges")
    ids = graph.pages_in_category(*tables.values(), category, edges).unionByName(graph.pages_in_category(*tables.values(), BOOKS, edges)).distinct()
    if done is not None:
        ids = context.without(ids, done)
    if limit is not None:
        ids = ids.orderBy("page_id").limit(limit)
    titles = context.title_ids(tables["pages"])
    if d.redirect:
        titles = saved(with_redirects(titles, raw["redirect"]), "titles")

    first = saved(classified(spark, d, ids, lang, tables), "pages-1")
    named = first.where("type = 'POETIC_COLLECTION'").select(F.explode("parsed.items.title").alias("title"))
    named = named.unionByName(first.where("type = 'MULTI_VERSION_HUB'").select(F.explode("parsed.sub_titles").alias("title")))
    named = named.unionByName(first.where("type = 'POEM' and parsed.source_collection != ''").select(F.col("parsed.source_collection").alias("title"))).distinct()
    found = context.resolve(named, titles).where("page_id is not null").select("page_id").distinct()
    known = first.select("page_id") if done is None else first.select("page_id").unionByName(done.select("page_id"))
    second = saved(classified(spark, d, context.without(found, known), lang, tables), "pages-2")
    every = first.unionByName(second)
    books = every.where("type = 'POETIC_COLLECTION'")
    poems = every.where("type = 'POEM'")
    items = listed_items(books)
    versions = every.where("type = 'MULTI_VERSION_HUB'").select(
        F.col("page_id").alias("hub_page_id"), F.col("title").alias("hub_title"), F.explode("parsed.sub_titles").alias("title")
    )
    hubs = context.resolve(versions, titles).where("page_id is not null and page_id != hub_page_id")
    best = hubs.groupBy("page_id").agg(F.max(F.struct("hub_page_id", "hub_title")).alias("h")).select("page_id", "h.*")
    order = context.build(items, titles, poems)
    rows = records(poems, order, best, books, dumps.read_xml(spark, d.xml, poems), lang)
    rows = saved(with_collections(rows, items, titles, books, lang), "records").orderBy("page_id")

    listed = context.resolve(items.where("kind = 'POEM'"), titles).join(books.select(F.col("page_id").alias("collection_id"), F.col("title").alias("ParentTitle")), "collection_id")
    above = listed.select("page_id", "ParentTitle").unionByName(hubs.select("page_id", F.col("hub_title").alias("ParentTitle")))
    above = above.where("page_id is not null").groupBy("page_id").agg(F.min("ParentTitle").alias("ParentTitle"))
    in_books = context.child_counts(items).select(F.col("collection_id").alias("page_id"), F.col("poems").alias("ChildCount"))
    in_hubs = hubs.groupBy(F.col("hub_page_id").alias("page_id")).agg(F.count(F.lit(1)).alias("ChildCount"))
    shown = every.where("type is not null").join(above, "page_id", "left")
    up = F.when(F.col("ParentTitle") != F.col("title"), F.col("ParentTitle"))
    tree = shown.select(
        F.lit(category).alias("author"), F.col("title").alias("node"), F.coalesce(up, F.lit(category)).alias("parent"), "type", "reason", F.lit("").alias("timestamp")
    )
    return Result(
        records=rows,
        other=_log(every.where("type in ('OTHER', 'AUTHOR')"), lang, above),
        collections=_log(books, lang, above, in_books),
        hubs=_log(every.where("type = 'MULTI_VERSION_HUB'"), lang, above, in_hubs),
        rejects=markup.rejects(every),
        tree=tree,
        pages=every,
    )


def with_redirects(titles: DataFrame, redirects: DataFrame) -> DataFrame:
    """titles (title, page_id) with the ids of redirects led to where they end; titles that end nowhere go.

    redirects: source, namespace, title, as in the dump.
    """
    targets = context.resolve(redirects.where("namespace = 0").select("source", "title"), titles).where("page_id is not null")
    resolved = graph.resolve_redirects(targets.select("source", F.col("page_id").alias("target")))
    lost = redirects.select("source").join(resolved.select("source"), "source", "left_anti").select("source", F.lit(None).cast("bigint").alias("resolved"))
    return context.follow(titles, resolved.unionByName(lost)).where("page_id is not null")


def write(spark: SparkSession, result: Result, output: str, append: bool = False, trees: bool = False) -> dict:
    """All sinks beside ``output``: records, cleaned records, index, logs, rejects and trees. Returns counts for the report."""
    corpus.write_jsonl(result.records, output, "append" if append else "overwrite")
    written = corpus.read_jsonl(spark, output)
    clean = ops.process(ops.best_version(written)).orderBy("first_ord")
    corpus.write_jsonl(clean, f"{output}.cleaned")
    schedule.upsert_index(ops.index_rows(result.records).withColumn("ord", F.lit(0)), f"{output}.index")
    corpus.write_log(result.other, f"{output}.logs/other_pages")
    corpus.write_log(result.collections, f"{output}.logs/collections", children=True)
    corpus.write_log(result.hubs, f"{output}.logs/hubs", children=True)
    result.rejects.write.mode("overwrite").option("header", True).csv(f"{output}.logs/rejects")
    if trees:
        corpus.write_trees(result.tree, f"{output}.trees")
    counts = {"records": written.count(), "cleaned": clean.count(), "rejected": result.rejects.count()}
    return counts | {r["type"] or "unreadable": r["count"] for r in result.pages.groupBy("type").count().collect()}
