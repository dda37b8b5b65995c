"""Queries of the page functions and list views over pages whose markup is built from the driver's tables.

``conversations`` gives one page a conversation: what stands in it follows from its number and turns, so the SQL says
what must come out of the page without reading its markup.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import links, markup, text
from ..operators import context, graph, records, views
from . import ingest
from .catalogue import _C, _DIFF, _GEO, _ID, _IDS, _NAMED, _STANZAS_SQL, _WIKI, _geo, _items, _other_geo, _pages, _wiki, corpus, query, sides, table

_LINE = (
    "case when t.turn = 5 then '<li><a href=\"/wiki/Z?a=1&amp;redlink=1\">Zed</a></li>' when t.turn % 3 = 0 then concat('<li><b>Part ', t.turn, '</b></li>') "
    "else concat('<li><a href=\"/wiki/T_', conv_id, '_', t.turn % 2, '\">x</a></li>') end"
)
_VERSE = (
    "concat('<p>', replace(replace(replace(coalesce(t.text, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '<br/><span class=\"x pagenum\">[7]</span>fin ', t.turn, '</p>')"
)
_HTML = (
    ("conv_id % 5 = 0", "'<div id=\"toc\"></div>'"),
    ("conv_id % 7 = 0", "'<div class=\"a ws-summary\"></div>'"),
    ("conv_id % 3 = 0", "concat('<a title=\"d:Q1', conv_id, '\">w</a>')"),
    ("conv_id % 11 = 0", "'<h3>Autres <i></i>Éditions</h3><h3>Éditions</h3>'"),
    ("conv_id % 2 = 0", "concat('<span itemprop=\"author\">Auteur : A', conv_id, '</span>')"),
    ("true", "'<span itemprop=\"author\">Second</span>'"),
    ("conv_id % 3 = 0", "concat('<time itemprop=\"datePublished\" content=\" 18', lpad(conv_id % 100, 2, '0'), ' \"></time>')"),
    ("conv_id % 5 < 3", "concat('<span itemprop=\"isPartOf\"><a href=\"#\">y<span itemprop=\"name\">Book ', conv_id % 10, '</span></a></span>')"),
    ("conv_id % 7 < 2", "'<meta itemprop=\"publisher\" content=\"Pub\">'"),
    ("conv_id % 11 < 4", "'<i itemprop=\"x translator\"> T </i>'"),
    ("conv_id % 6 = 1", "concat('<a href=\"/wiki/P_', conv_id, '_(v1)#s\">a</a><a href=\"./p_', conv_id, '/x\">b</a><a href=\"/wiki/Q\">c</a><a href=\"http://x/P_', conv_id, '\">d</a>')"),
    ("conv_id % 2 = 0", f"concat('<div class=\"poem\">', array_join(transform(turns, t -> {_VERSE}), ''), '</div>')"),
    ("conv_id % 4 <> 3", f"concat('<div class=\"mw-parser-output\"><ul>', array_join(transform(turns, t -> {_LINE}), ''), '</ul></div>')"),
)
_TITLE = "CASE WHEN conv_id % 38 = 0 THEN 'Auteur:X' ELSE concat('P ', conv_id) END"


def _built(spark, sf_dir):
    turns = F.sort_array(F.collect_list(F.struct("turn", "text"))).alias("turns")
    pages = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(turns)
    html = F.concat(*[F.expr(f"case when {when} then {part} else '' end") for when, part in _HTML])
    categories = F.expr(
        "case when conv_id % 13 = 0 then array('Catégorie:Recueils de poèmes', 'x') when conv_id % 17 = 0 then array('Éditions multiples') else cast(array() as array<string>) end"
    )
    return pages.select(
        F.col("conv_id").alias("page_id"), F.expr(_TITLE).alias("title"), F.expr("case when conv_id % 19 = 0 then 102 else 0 end").alias("namespace"), categories.alias("categories"), html.alias("html")
    )


def _classified(spark, sf_dir):
    return markup.classify(_built(spark, sf_dir))


_CONV = "c AS (SELECT DISTINCT conv_id FROM conversations)"


@query(
    f"WITH {_CONV} SELECT conv_id AS page_id, conv_id % 3 = 0 AS wikidata, conv_id % 7 = 0 AS ws_summary, conv_id % 5 = 0 AS toc, conv_id % 11 = 0 AS editions_header, "
    "conv_id % 4 <> 3 AS list_items FROM c"
)
def page_signals(spark, sf_dir):
    return _classified(spark, sf_dir).select("page_id", *[f"parsed.{s}" for s in markup._SIGNALS])


_KEYS = (("ws_summary", 7), ("toc", 5), ("editions_header", 11))
_RULES = [("conv_id % 38 = 0", "AUTHOR", "is_author_page"), ("conv_id % 19 = 0", "OTHER", "is_other_namespace"), ("conv_id % 13 = 0", "POETIC_COLLECTION", "is_recueil_cat")]
_RULES += [("conv_id % 17 = 0", "MULTI_VERSION_HUB", "is_multiversion_cat")]
for _key, _n in _KEYS:
    _RULES += [(f"conv_id % {_n * 3} = 0", "MULTI_VERSION_HUB", f"has_donnees_structurees and {_key}"), (f"conv_id % {_n} = 0", "POETIC_COLLECTION", _key)]
_RULES += [("conv_id % 2 = 0", "POEM", "has_poem_structure"), ("conv_id % 3 = 0 AND conv_id % 4 <> 3", "MULTI_VERSION_HUB", "has_donnees_structurees and has_list_items")]
_CASE = " ".join("WHEN {0} THEN '{1}'".format(w, "{" + str(i) + "}") for i, (w, *_) in enumerate(_RULES))


@query(
    f"WITH {_CONV} SELECT conv_id AS page_id, CASE {_CASE.format(*[t for _, t, _ in _RULES])} ELSE 'OTHER' END AS type, "
    f"CASE {_CASE.format(*[r for _, _, r in _RULES])} ELSE 'no_signals_matched' END AS reason FROM c"
)
def page_class(spark, sf_dir):
    return _classified(spark, sf_dir).select("page_id", "type", "reason")


_BLOCK = "coalesce(string_agg(concat(coalesce(text, ''), chr(10), 'fin ', turn, chr(10), chr(10)), '' ORDER BY turn) FILTER (WHERE conv_id % 2 = 0), '')"


@query(
    f"WITH b AS (SELECT conv_id, {_BLOCK} AS body FROM conversations GROUP BY conv_id), t AS (SELECT conv_id, {_STANZAS_SQL.format('body')} AS s FROM b) "
    "SELECT conv_id AS page_id, len(s)::BIGINT AS stanzas, array_to_string(list_transform(s, lambda x: array_to_string(x, chr(10))), chr(10) || chr(10)) AS joined, "
    "CASE WHEN conv_id % 2 = 0 THEN '<div class=\"poem\">' ELSE '' END AS markers FROM t"
)
def page_structure(spark, sf_dir):
    found = _classified(spark, sf_dir).withColumn("s", markup.stanzas(F.col("parsed")))
    return found.select("page_id", F.size("s").cast("long").alias("stanzas"), text.joined_stanzas(F.col("s")).alias("joined"), F.array_join("parsed.raw_markers", "|").alias("markers"))


@query(
    "WITH i AS (SELECT conv_id, turn, CASE WHEN turn = 5 THEN 'Zed' WHEN turn % 3 = 0 THEN concat('Part ', turn) ELSE concat('T ', conv_id, ' ', turn % 2) END AS title, "
    "CASE WHEN turn = 5 OR turn % 3 = 0 THEN 'SECTION_TITLE' ELSE 'POEM' END AS kind FROM conversations WHERE conv_id % 4 <> 3), "
    "f AS (SELECT conv_id, title, kind, min(turn) AS turn FROM i GROUP BY ALL) "
    "SELECT conv_id AS page_id, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1)::INT AS pos, title, kind FROM f"
)
def page_items(spark, sf_dir):
    rows = _classified(spark, sf_dir).select("page_id", F.posexplode("parsed.items").alias("pos", "i"))
    return rows.select("page_id", "pos", "i.title", "i.kind")


@query(
    f"WITH {_CONV} SELECT conv_id AS page_id, CASE WHEN conv_id % 2 = 0 THEN concat('Auteur : A', conv_id) ELSE 'Second' END AS author, "
    "CASE WHEN conv_id % 3 = 0 THEN concat('18', lpad((conv_id % 100)::VARCHAR, 2, '0')) END AS publication_date, "
    "CASE WHEN conv_id % 5 < 3 THEN concat('Book ', conv_id % 10) END AS source_collection, CASE WHEN conv_id % 7 < 2 THEN 'Pub' END AS publisher, "
    "CASE WHEN conv_id % 11 < 4 THEN 'T' END AS translator FROM c"
)
def page_itemprops(spark, sf_dir):
    return _classified(spark, sf_dir).select("page_id", *[f"parsed.{m}" for m in ("author", "publication_date", "source_collection", "publisher", "translator")])


@query(
    f"WITH {_CONV} SELECT conv_id AS page_id, unnest([concat('P ', conv_id, ' (v1)'), concat('p ', conv_id, '/x')]) AS title FROM c WHERE conv_id % 6 = 1 AND conv_id % 38 <> 0"
)
def page_versions(spark, sf_dir):
    return _classified(spark, sf_dir).select("page_id", F.explode("parsed.sub_titles").alias("title"))


@query(f"SELECT page_id, count(*) FILTER (WHERE kind = 'POEM') AS poems, count(*) FILTER (WHERE kind <> 'POEM') AS sections FROM (SELECT conv_id AS page_id, CASE role WHEN 'user' THEN 'S' ELSE 'POEM' END AS kind FROM conversations) GROUP BY page_id")
def child_counts(spark, sf_dir):
    return context.child_counts(_items(spark, sf_dir)).withColumnRenamed("collection_id", "page_id")


_WIKITEXT = (
    "case conv_id % 4 when 0 then concat('{{Auteur|A', conv_id, '}}{{titre|auteur=B|recueil=R', conv_id, '}}') "
    "when 1 then concat('x {{infoédit|AUTEUR=[[Auteur:C', conv_id, '|c]]|ANNÉE=18{{x|{{y|z=1}}}}05|RECUEIL=<i>R</i> [[s|t]]}}') "
    "when 2 then '{{titre|auteur=|recueil=S}} {{author|D}}' else '{{open [[a|b]] no templates }' end"
)


@query(
    f"WITH {_CONV} SELECT conv_id AS page_id, CASE conv_id % 4 WHEN 0 THEN concat('A', conv_id) WHEN 1 THEN concat('C', conv_id) WHEN 2 THEN '' END AS author, "
    "CASE WHEN conv_id % 4 = 1 THEN '1805' END AS publication_date, CASE conv_id % 4 WHEN 0 THEN concat('R', conv_id) WHEN 1 THEN 'R t' WHEN 2 THEN 'S' END AS source_collection FROM c"
)
def wikitext_templates(spark, sf_dir):
    pages = table(spark, sf_dir, "conversations").select("conv_id").distinct()
    return pages.select(F.col("conv_id").alias("page_id"), markup.wikitext(F.expr(_WIKITEXT)).alias("w")).select("page_id", "w.*")


# -- names, links, shallow trees, counts ---------------------------------------------------------------------


@query(
    "SELECT doc_id, concat('https://', lang, '.wikisource.org/wiki/', replace(replace(replace(url_encode(replace(concat(source, ' é/', doc_id, ' (x)~*+'), ' ', '_')), '%2F', '/'), '%7E', '~'), '+', '%2B')) AS url, "
    "lower(regexp_replace(concat(source, '/A b:', doc_id, '?'), '[\\/*?:\"<>| ]', '_', 'g')) AS file, list_extract(string_split(concat('K:', source, '/', doc_id), '/'), -1) AS last, "
    "list_extract(string_split(concat('Auteur:', source), ':'), -1) AS author FROM documents WHERE lang IS NOT NULL AND source IS NOT NULL"
)
def names_and_urls(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").where("lang is not null and source is not null")
    title = F.expr("concat(source, ' é/', doc_id, ' (x)~*+')")
    return rows.select(
        "doc_id",
        text.page_url(F.col("lang"), title).alias("url"),
        text.file_name(F.expr("concat(source, '/A b:', doc_id, '?')")).alias("file"),
        text.last_segment(F.expr("concat('K:', source, '/', doc_id)")).alias("last"),
        text.after_colon(F.expr("concat('Auteur:', source)")).alias("author"),
    )


_HREF = (
    "case event_id % 8 when 0 then '/wiki/A_b' when 1 then './A%20b#s' when 2 then '/wiki/Auteur:X' when 3 then '/wiki/Aide:Y' when 4 then '/wiki/A&redlink=1' "
    "when 5 then '/w/index.php?title=A&action=edit' when 6 then 'http://x/wiki/A' else '/wiki/Catégorie:K' end"
)


@query("SELECT event_id, event_id % 8 IN (0, 1) AS inside, event_id % 8 IN (0, 1, 2, 7) AS inside_en FROM events")
def internal_links(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumn("href", F.expr(_HREF))
    title = links.href_title(F.col("href"))
    return rows.select("event_id", links.internal(F.col("href"), title).alias("inside"), links.internal(F.col("href"), title, "en").alias("inside_en"))


@query(
    f"WITH {_WIKI}, t AS (SELECT doc_id FROM documents WHERE doc_id % 2 = 0) SELECT DISTINCT concat('C ', s.child) AS category, l.page_id, concat('C ', l.page_id) AS title "
    "FROM sub s JOIN leaf l ON l.parent = s.child WHERE s.parent = 4"
)
def category_shallow(spark, sf_dir):
    return graph.shallow_members(*_wiki(spark, sf_dir), "C_4")


@query("SELECT count(*) FILTER (WHERE doc_id % 3 <> 0 AND doc_id % 50 = 1) AS dropped_a, count(*) FILTER (WHERE doc_id % 3 = 0 AND doc_id % 50 = 1) AS dropped_b FROM documents")
def merge_dropped(spark, sf_dir):
    rows = corpus(spark, sf_dir).withColumn("page_id", F.expr("if(ord % 50 = 1, null, page_id)"))
    return records.dropped_counts(rows.where("src = 'A'"), rows.where("src = 'B'"))


# -- lookups over redirects, feedback ----------------------------------------------------------------------

_MOVED = f"{_IDS}, r AS (SELECT doc_id AS source, CASE WHEN doc_id % 12 = 8 THEN concat('T ', doc_id // 3 + 1) ELSE 'nowhere' END AS title FROM documents WHERE doc_id % 12 IN (2, 8))"


@query(
    f"WITH {_MOVED} SELECT ids.title, coalesce(CASE WHEN r.source IS NULL THEN ids.page_id END, t.page_id) AS page_id FROM ids LEFT JOIN r ON r.source = ids.page_id "
    "LEFT JOIN ids t ON t.title = r.title WHERE r.source IS NULL OR t.page_id IS NOT NULL"
)
def titles_over_redirects(spark, sf_dir):
    doc = table(spark, sf_dir, "documents").where("doc_id % 12 in (2, 8)")
    title = F.expr("case when doc_id % 12 = 8 then concat('T_', doc_id div 3 + 1) else 'nowhere' end")
    moved = doc.select(F.col("doc_id").alias("source"), F.lit(0).alias("namespace"), title.alias("title"))
    return ingest.with_redirects(context.title_ids(_pages(spark, sf_dir)), moved)


@query(
    f"WITH {_C}, ids AS (SELECT concat('r', doc_id % 20) AS title, max(doc_id) AS page_id FROM documents GROUP BY ALL), "
    "named AS (SELECT DISTINCT source_collection AS title FROM corpus WHERE collection_page_id IS NULL AND source_collection <> '') "
    "SELECT DISTINCT page_id FROM named JOIN ids USING (title) WHERE page_id NOT IN (SELECT doc_id FROM labels)"
)
def upward_inference(spark, sf_dir):
    ids = table(spark, sf_dir, "documents").groupBy(F.expr("concat('r', doc_id % 20)").alias("title")).agg(F.max("doc_id").alias("page_id"))
    return context.upward(corpus(spark, sf_dir), ids, table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id")))


@query(
    "WITH f AS (SELECT user_id AS page_id, bool_or(event_type = 'purchase') AS has_context FROM events WHERE event_id % 2 = 0 GROUP BY user_id), "
    "s AS (SELECT user_id AS page_id, bool_or(event_type = 'purchase') AS had FROM events WHERE event_id % 2 = 1 AND event_id % 3 = 0 GROUP BY user_id) "
    "SELECT page_id, has_context FROM f LEFT JOIN s USING (page_id) WHERE had IS NULL OR (has_context AND NOT had)"
)
def feedback_pending(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("page_id"), (F.col("event_type") == "purchase").alias("has_context"))
    part = F.expr("case when event_id % 2 = 0 then 'found' when event_id % 3 = 0 then 'seen' end")
    rows = rows.withColumn("part", part)  # both sides of one table: what this round finds, what earlier ones saw
    return context.pending(rows.where("part = 'found'"), rows.where("part = 'seen'"))


# -- orders of lists ---------------------------------------------------------------------------------------

_AUTHORS = (
    f"authors AS (SELECT who AS author, count(DISTINCT CASE WHEN {_ID} THEN collection_page_id END) AS collection_count, count(*) FILTER (WHERE NOT coalesce({_ID}, false)) AS orphan_count "
    "FROM named GROUP BY who)"
)


@query(
    f"WITH {_NAMED}, {_AUTHORS} SELECT author, collection_count, orphan_count, row_number() OVER (ORDER BY collection_count + orphan_count DESC, author) - 1 AS place FROM authors"
)
def author_sort(spark, sf_dir):
    return views.author_sort_list(corpus(spark, sf_dir), "poemCount", descending=True).withColumn("place", F.col("place").cast("long"))


@query(f"WITH {_NAMED} SELECT author, row_number() OVER (ORDER BY lower(author)) - 1 AS place FROM (SELECT DISTINCT who AS author FROM named)")
def author_choices(spark, sf_dir):
    return views.author_choices(corpus(spark, sf_dir)).withColumn("place", F.col("place").cast("long"))


@query(
    f"WITH {_NAMED}, twice AS (SELECT *, count(*) OVER (PARTITION BY who, title) AS n FROM named), p AS (SELECT who AS author, panel, page_id, ord, title FROM named UNION ALL "
    f"SELECT who, '{views.SEVERAL}', page_id, ord, title FROM twice WHERE n > 1) SELECT author, panel, page_id, ord, title, row_number() OVER (PARTITION BY author "
    f"ORDER BY CASE panel WHEN '{views.SEVERAL}' THEN 0 WHEN '{views.NO_SOURCE}' THEN 2 ELSE 1 END, lower(panel), lower(coalesce(title, '')), ord) - 1 AS place FROM p"
)
def panel_places(spark, sf_dir):
    return views.panel_places(corpus(spark, sf_dir)).withColumn("place", F.col("place").cast("long"))


@query(
    f"WITH {_DIFF}, t AS (SELECT page_id, min(title) AS title FROM corpus GROUP BY page_id) SELECT page_id, status, title, "
    "row_number() OVER (PARTITION BY status ORDER BY lower(coalesce(title, '')), page_id) - 1 AS place FROM d LEFT JOIN t USING (page_id) WHERE status <> 'same'"
)
def diff_places(spark, sf_dir):
    titles = corpus(spark, sf_dir).groupBy("page_id").agg(F.min("title").alias("title"))
    return views.diff_places(records.diff(*sides(spark, sf_dir)), titles).withColumn("place", F.col("place").cast("long"))


@query(
    f"WITH {_GEO}, nodes2 AS (SELECT node, CASE WHEN node = 'n3' THEN 'STATE' ELSE type END AS type FROM nodes WHERE node NOT LIKE 'n%9' UNION ALL SELECT 'r9', 'REGION'), "
    "edges2 AS (SELECT CASE WHEN child = 'n7' THEN 'r0' ELSE parent END AS parent, child FROM edges WHERE child NOT LIKE 'n%9' AND parent NOT LIKE 'n%9'), "
    "moved AS (SELECT parent AS node FROM (SELECT * FROM edges EXCEPT SELECT * FROM edges2) UNION SELECT parent FROM (SELECT * FROM edges2 EXCEPT SELECT * FROM edges)), "
    "f AS (SELECT coalesce(a.node, b.node) AS node, CASE WHEN a.node IS NULL THEN 'added' WHEN b.node IS NULL THEN 'removed' "
    "WHEN a.type IS DISTINCT FROM b.type OR a.node IN (SELECT node FROM moved) THEN 'modified' END AS status FROM nodes a FULL JOIN nodes2 b ON a.node = b.node) "
    "SELECT node, status, row_number() OVER (PARTITION BY status ORDER BY node) - 1 AS place FROM f WHERE status IS NOT NULL"
)
def tree_diff_places(spark, sf_dir):
    found = graph.compare_trees(graph.flatten(*_geo(spark, sf_dir)), graph.flatten(*_other_geo(spark, sf_dir)))
    return graph.changes_in_order(found).select("node", "status", F.col("place").cast("long").alias("place"))


@query(
    f"WITH RECURSIVE {_GEO}, up AS (SELECT node FROM nodes WHERE type = 'BUILDING' UNION SELECT parent FROM edges JOIN up ON child = node), "
    "shown AS (SELECT n.node, n.type, e.parent FROM nodes n SEMI JOIN up USING (node) LEFT JOIN edges e ON e.child = n.node), "
    "k AS (SELECT parent AS node, count(*) AS child_count FROM shown WHERE parent IS NOT NULL GROUP BY parent) "
    "SELECT node, parent, type, coalesce(child_count, 0) AS child_count, row_number() OVER (PARTITION BY parent ORDER BY coalesce(child_count, 0) DESC, node) - 1 AS place FROM shown LEFT JOIN k USING (node)"
)
def tree_view(spark, sf_dir):
    found = graph.tree_view(*_geo(spark, sf_dir), ["BUILDING"], by="child_count", descending=True)
    return found.withColumn("place", F.col("place").cast("long"))
