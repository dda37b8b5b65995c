"""Queries of the readers and writers: each writes files from the driver's tables, reads them again and returns the rows.

The SQL says what must come back, from the same tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import corpus as files
from ..sources import dumps
from ..sources.shared import temporary
from ..streaming import schedule
from . import ingest
from .catalogue import _STANZAS_SQL, corpus, query, table
from .wiki_queries import _BLOCK, _RULES, _built


def _written(spark, values, compression: str = "none") -> str:
    """values: column value. The folder of the text files."""
    path = temporary(spark)
    values.write.option("compression", compression).text(path)
    return path


def _xml(spark, pages) -> str:
    """pages: key, value (a page element). Some files, each with one root around its pages."""
    rows = pages.select((F.col("key") % 4).alias("file"), F.lit(1).alias("place"), "value")
    ends = spark.range(4).select(F.col("id").alias("file"), F.explode(F.array(F.struct(F.lit(0).alias("place"), F.lit("<mediawiki>").alias("value")), F.struct(F.lit(2).alias("place"), F.lit("</mediawiki>").alias("value")))).alias("e"))
    rows = rows.unionByName(ends.select("file", "e.*")).repartition(4, "file").sortWithinPartitions("file", "place")
    path = temporary(spark)
    rows.select("file", "value").write.partitionBy("file").text(path)
    return path


def _quoted(c: str):
    """A string as the dumps write it."""
    out = F.coalesce(F.col(c), F.lit(""))
    for plain, escaped in (("\\", "\\\\"), ("'", "\\'"), ("\n", "\\n"), ("\r", "\\r")):
        out = F.replace(out, F.lit(plain), F.lit(escaped))
    return F.concat(F.lit("'"), out, F.lit("'"))


def _inserts(spark, name: str, *tuples):
    """One INSERT line a row; tuples: lists of columns."""
    body = F.concat_ws(",", *[F.concat(F.lit("("), F.concat_ws(",", *t), F.lit(")")) for t in tuples])
    return F.concat(F.lit(f"INSERT INTO `{name}` VALUES "), body, F.lit(";")).alias("value")


@query(
    "SELECT doc_id AS page_id, (doc_id % 2 * 14)::INT AS namespace, replace(substr(coalesce(text, ''), 1, 60), '_', ' ') AS title, "
    "(CASE WHEN doc_id % 3 = 0 THEN 1 ELSE 0 END)::INT AS is_redirect, n_chars::INT AS page_len FROM documents"
)
def dump_pages(spark, sf_dir):
    """Of rows with one key the first stays; a tuple whose numbers cannot be read goes."""
    doc = table(spark, sf_dir, "documents").withColumn("t", F.substring(F.coalesce("text", F.lit("")), 1, 60))
    own = [F.expr(e) for e in ("doc_id", "doc_id % 2 * 14")] + [_quoted("t")] + [F.expr(e) for e in ("if(doc_id % 3 = 0, 1, 0)", "0", "'0.5'", "\"''\"", "\"''\"", "7", "n_chars", "'NULL'")]
    late = [F.expr("doc_id"), *[F.expr(e) for e in ("0", "\"'later (x),y'\"", "0", "0", "0", "'NULL'", "'NULL'", "0", "1", "'NULL'")]]
    odd = [F.expr("\"'x'\""), *late[1:]]
    path = _written(spark, doc.select(_inserts(spark, "page", own, odd, late)))
    return dumps.read_sql(spark, path, "page")


@query("SELECT doc_id AS page_id, CASE WHEN doc_id % 4 = 0 THEN 'subcat' ELSE 'page' END AS type, (1000000 + doc_id // 7)::BIGINT AS target_id FROM documents")
def dump_links(spark, sf_dir):
    doc = table(spark, sf_dir, "documents").withColumn("t", F.substring(F.coalesce("text", F.lit("")), 1, 20))
    row = [F.expr("doc_id"), _quoted("t"), F.expr("\"''\""), F.expr("\"''\""), F.expr("if(doc_id % 4 = 0, \"'subcat'\", \"'page'\")"), F.expr("1"), F.expr("1000000 + doc_id div 7")]
    return dumps.read_sql(spark, _written(spark, doc.select(_inserts(spark, "categorylinks", row))), "categorylinks")


@query("SELECT doc_id AS target_id, (doc_id % 15)::INT AS namespace, substr(coalesce(text, ''), 1, 30) AS title FROM documents")
def dump_targets(spark, sf_dir):
    doc = table(spark, sf_dir, "documents").withColumn("t", F.substring(F.coalesce("text", F.lit("")), 1, 30))
    row = [F.expr("doc_id"), F.expr("doc_id % 15"), _quoted("t")]
    return dumps.read_sql(spark, _written(spark, doc.select(_inserts(spark, "linktarget", row))), "linktarget")


@query("SELECT doc_id AS source, (doc_id % 3)::INT AS namespace, concat('T_', doc_id // 2) AS title FROM documents WHERE doc_id % 5 = 0")
def dump_redirects(spark, sf_dir):
    doc = table(spark, sf_dir, "documents").where("doc_id % 5 = 0").withColumn("t", F.expr("concat('T_', doc_id div 2)"))
    row = [F.expr("doc_id"), F.expr("doc_id % 3"), _quoted("t"), F.expr("'NULL'"), F.expr("\"''\"")]
    return dumps.read_sql(spark, _written(spark, doc.select(_inserts(spark, "redirect", row))), "redirect")


def _ndjson(spark, sf_dir) -> str:
    doc = table(spark, sf_dir, "documents")
    page = F.struct(
        F.expr("if(doc_id % 9 = 0, null, doc_id)").alias("identifier"),
        F.col("source").alias("name"),
        F.expr("if(doc_id % 4 = 0, null, named_struct('identifier', doc_id + 5, 'other', 'x'))").alias("version"),
        F.expr("if(doc_id % 6 = 0, null, named_struct('html', text))").alias("article_body"),
        F.lit("more").alias("unknown"),
    )
    line = F.when(F.expr("doc_id % 10 = 3"), F.concat(F.lit("{bad "), "doc_id")).when(F.expr("doc_id % 10 = 4"), F.lit(" ")).otherwise(F.to_json(page))
    return _written(spark, doc.select(line.alias("value")), "gzip")


@query(
    "SELECT doc_id AS page_id, CASE WHEN doc_id % 4 = 0 THEN 0 ELSE doc_id + 5 END AS revision_id, coalesce(source, '') AS title, '' AS url, "
    "CASE WHEN doc_id % 6 = 0 THEN '' ELSE coalesce(text, '') END AS html, '' AS date_modified FROM documents WHERE doc_id % 9 <> 0 AND doc_id % 10 NOT IN (3, 4)"
)
def ndjson_pages(spark, sf_dir):
    return dumps.read_ndjson(spark, _ndjson(spark, sf_dir))


@query(
    "SELECT CASE WHEN doc_id % 10 = 3 THEN 'broken' ELSE 'no id' END AS reason, count(*) AS n FROM documents WHERE doc_id % 10 = 3 OR (doc_id % 9 = 0 AND doc_id % 10 <> 4) GROUP BY ALL"
)
def ndjson_losses(spark, sf_dir):
    return dumps.broken_ndjson(spark, _ndjson(spark, sf_dir)).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query(
    "SELECT conv_id * 100 + turn AS page_id, CASE WHEN turn % 3 = 0 THEN 0 ELSE conv_id END AS revision_id, concat('P & ', turn) AS title, "
    "CASE WHEN turn % 5 = 2 THEN '' ELSE coalesce(text, '') END AS wikitext FROM conversations WHERE turn % 4 <> 1"
)
def xml_pages(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations")
    text = F.expr("replace(replace(replace(coalesce(text, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;')")
    revision = F.concat(
        F.expr("if(turn % 3 = 0, '', concat('<id>', conv_id, '</id>'))"), F.when(F.expr("turn % 5 = 2"), F.lit("")).otherwise(F.concat(F.lit("<text bytes='3' xml:space='preserve'>"), text, F.lit("</text>")))
    )
    page = F.concat(
        F.expr("concat('<page><title>P &amp; ', turn, '</title><ns>', if(turn % 4 = 1, 14, 0), '</ns><id>', conv_id * 100 + turn, '</id><revision>')"),
        revision,
        F.lit("</revision><revision><id>9</id><text>second</text></revision></page>"),
    )
    return dumps.read_xml(spark, _xml(spark, rows.select(F.col("conv_id").alias("key"), page.alias("value")))).select("page_id", "revision_id", "title", "wikitext")


def _jsonl(spark, sf_dir) -> str:
    rows = corpus(spark, sf_dir)
    record = F.to_json(F.struct("page_id", "title", "metadata", "structure", "normalized_text", "collection_page_id"))
    line = F.when(F.expr("ord % 10 = 3"), F.lit('{"page_id": 1, "ti')).when(F.expr("ord % 10 = 4"), F.lit("  ")).otherwise(record)
    return _written(spark, rows.select(line.alias("value")), "gzip")


@query(
    "SELECT doc_id // 4 AS page_id, concat(lang, '/', source, ' (v', doc_id % 3, ')') AS title, CASE WHEN doc_id % 7 <> 0 THEN source END AS author, text AS normalized_text "
    "FROM documents WHERE doc_id % 10 NOT IN (3, 4)"
)
def jsonl_records(spark, sf_dir):
    """gzip JSON lines with blank and broken ones among them."""
    rows = files.read_jsonl(spark, _jsonl(spark, sf_dir))
    return rows.select("page_id", "title", "metadata.author", "normalized_text")


@query("SELECT count(*) FILTER (WHERE doc_id % 10 = 3) AS broken FROM documents")
def jsonl_broken(spark, sf_dir):
    return files.read_broken(spark, _jsonl(spark, sf_dir)).agg(F.count(F.lit(1)).alias("broken"))


@query("SELECT DISTINCT doc_id // 4 AS page_id FROM documents")
def resume_ids(spark, sf_dir):
    """What a run has written and the next one finds done."""
    path = temporary(spark)
    files.write_jsonl(corpus(spark, sf_dir).drop("src"), path)
    return files.processed_ids(spark, path)


@query(
    "SELECT '2020-01-01 00:00:00' AS \"Timestamp\", concat(lang, ', \"', source, '\"') AS \"PageTitle\", concat('u', doc_id) AS \"URL\", CASE WHEN doc_id % 2 = 0 THEN source END AS \"ParentTitle\", "
    "'is_recueil_cat' AS \"Reason\", (doc_id % 4)::VARCHAR AS \"ChildCount\" FROM documents WHERE doc_id % 3 = 0 AND lang IS NOT NULL AND source IS NOT NULL"
)
def audit_log(spark, sf_dir):
    doc = table(spark, sf_dir, "documents").where("doc_id % 3 = 0 and lang is not null and source is not null")
    rows = doc.select(
        F.lit("2020-01-01 00:00:00").alias("Timestamp"), F.expr("concat(lang, ', \"', source, '\"')").alias("PageTitle"), F.expr("concat('u', doc_id)").alias("URL"),
        F.expr("case when doc_id % 2 = 0 then source end").alias("ParentTitle"), F.lit("is_recueil_cat").alias("Reason"), F.expr("doc_id % 4").alias("ChildCount"),
    )
    path = temporary(spark)
    files.write_log(rows, path, children=True)
    return spark.read.option("header", True).csv(path)


_TREE = (
    "SELECT concat('Author:r', n_regionkey) AS author, concat('n', n_nationkey) AS node, concat('Author:r', n_regionkey) AS parent, 'NATION' AS type FROM nation UNION ALL "
    "SELECT concat('Author:r', n_regionkey), concat('c', c_custkey), concat('n', c_nationkey), c_mktsegment FROM customer JOIN nation ON n_nationkey = c_nationkey"
)


@query(f"SELECT node, parent, type FROM ({_TREE})")
def tree_files(spark, sf_dir):
    """Trees written as nested JSON, one a region, and unwound again."""
    nation, customer = (table(spark, sf_dir, t) for t in ("nation", "customer"))
    root = F.expr("concat('Author:r', n_regionkey)")
    rows = nation.select(root.alias("author"), F.expr("concat('n', n_nationkey)").alias("node"), root.alias("parent"), F.lit("NATION").alias("type"))
    below = customer.join(nation, F.col("n_nationkey") == F.col("c_nationkey"))
    below = below.select(root.alias("author"), F.expr("concat('c', c_custkey)").alias("node"), F.expr("concat('n', c_nationkey)").alias("parent"), F.col("c_mktsegment").alias("type"))
    nodes = rows.unionByName(below).withColumn("reason", F.lit("x")).withColumn("timestamp", F.lit("1"))
    path = temporary(spark)
    files.write_trees(nodes, path)
    return files.read_tree(spark, f"{path}/json").where("parent is not null").select("node", "parent", "type")


@query(
    "WITH r AS (SELECT doc_id // 4 AS page_id, doc_id AS ord, doc_id % 3 AS batch, source AS title FROM documents) "
    "SELECT page_id, ord, title FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY batch DESC, ord DESC) AS n FROM r) WHERE n = 1"
)
def index_upserts(spark, sf_dir):
    """Three micro-batches, the second one twice."""
    rows = table(spark, sf_dir, "documents").select(F.expr("doc_id div 4").alias("page_id"), F.col("doc_id").alias("ord"), F.col("source").alias("title"))
    path = temporary(spark)
    for k in (0, 1, 1, 2):
        schedule.upsert_index(rows.where(F.col("ord") % 3 == k), path, k)
    return schedule.read_index(spark, path)


#: No namespace but 0 and no category but one reach the classifier from these files.
_RULED = " ".join(f"WHEN {w} THEN '{t}'" for w, t, r in _RULES if r not in ("is_author_page", "is_other_namespace", "is_multiversion_cat"))


@query(
    f"WITH b AS (SELECT conv_id, {_BLOCK} AS body FROM conversations GROUP BY conv_id), "
    f"t AS (SELECT conv_id, {_STANZAS_SQL.format('body')} AS s FROM b WHERE CASE {_RULED} ELSE 'OTHER' END = 'POEM') "
    "SELECT conv_id AS page_id, concat('P ', conv_id) AS title, concat('A', conv_id) AS author, CASE WHEN conv_id % 3 = 0 THEN concat('18', lpad((conv_id % 100)::VARCHAR, 2, '0')) "
    "END AS publication_date, coalesce(CASE WHEN conv_id % 5 < 3 THEN concat('Book ', conv_id % 10) END, CASE WHEN conv_id % 4 = 2 THEN 'S' END) AS source_collection, "
    "len(s)::BIGINT AS stanzas, sha256(CASE conv_id % 4 WHEN 2 THEN '{{titre|auteur=|recueil=S}} {{author|D}}' ELSE '' END) AS checksum_sha256, conv_id AS hub_page_id FROM t"
)
def ingest_records(spark, sf_dir):
    """The whole ingest over dump files that are written from the tables: records of the poems of one category tree."""
    pages = _built(spark, sf_dir).select("page_id", F.expr("concat('P_', page_id)").alias("title"), "categories", "html")
    conv = pages.select("page_id")
    path = temporary(spark)

    def put(frame, name: str) -> str:
        frame.write.text(f"{path}/{name}")
        return f"{path}/{name}"

    zero, none = F.lit("0"), F.lit("''")
    own = [F.expr("page_id"), zero, _quoted("title"), zero, zero, zero, none, none, zero, F.lit("9"), none, F.lit("NULL")]
    top = spark.range(1).select(F.lit("INSERT INTO `page` VALUES (900000001,14,'Sub',0,0,0,'','',0,9,'',NULL);").alias("value"))
    links = [F.expr("page_id"), none, none, none, F.lit("'page'"), zero, F.expr("if(page_id % 2 = 0, 100, 101)")]
    book = [*links[:6], F.lit("102")]
    up = spark.range(1).select(F.lit("INSERT INTO `categorylinks` VALUES (900000001,'','','','subcat',0,100);").alias("value"))
    books = pages.where("page_id % 13 = 0").select(_inserts(spark, "categorylinks", book))
    targets = spark.range(1).select(F.lit("INSERT INTO `linktarget` VALUES (100,14,'Poems'),(101,14,'Sub'),(102,14,'Recueils_de_poèmes');").alias("value"))
    html = pages.select(F.to_json(F.struct(F.col("page_id").alias("identifier"), F.expr("concat('P ', page_id)").alias("name"), F.struct("html").alias("article_body"))).alias("value"))
    wikitext = F.expr("case page_id % 4 when 2 then '{{titre|auteur=|recueil=S}} {{author|D}}' else '' end")
    xml = pages.where("page_id % 4 = 2").select(F.col("page_id").alias("key"), F.concat(F.expr("concat('<page><title>P ', page_id, '</title><ns>0</ns><id>', page_id, '</id><revision><id>1</id><text>')"), wikitext, F.lit("</text></revision></page>")).alias("value"))
    d = ingest.Dumps(
        put(pages.select(_inserts(spark, "page", own)).unionByName(top), "page.sql"),
        put(conv.select(_inserts(spark, "categorylinks", links)).unionByName(up).unionByName(books), "categorylinks.sql"),
        put(targets, "linktarget.sql"),
        put(html, "html.ndjson"),
        _xml(spark, xml),
    )
    found = ingest.ingest(spark, d, "Poems", "fr", f"{path}/work").records
    return found.select(
        "page_id", "title", "metadata.author", "metadata.publication_date", "metadata.source_collection", F.size("structure.stanzas").cast("long").alias("stanzas"), "checksum_sha256", "hub_page_id"
    )
