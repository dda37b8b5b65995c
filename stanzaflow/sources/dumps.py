"""Wiki dumps: SQL inserts, NDJSON pages, XML pages."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import spaced
from ..operators import context

_ESCAPES = {"n": "\n", "r": "\r", "t": "\t", "0": "\0"}

#: Table columns: place in the tuple, name, type.
TABLES = {
    "page": [(0, "page_id", "bigint"), (1, "namespace", "int"), (2, "title", "string"), (3, "is_redirect", "int"), (9, "page_len", "int")],
    "categorylinks": [(0, "page_id", "bigint"), (4, "type", "string"), (6, "target_id", "bigint")],
    "linktarget": [(0, "target_id", "bigint"), (1, "namespace", "int"), (2, "title", "string")],
    "redirect": [(0, "source", "bigint"), (1, "namespace", "int"), (2, "title", "string")],
}
#: Tuples that are handed on together.
_TUPLES = 20_000
_KEYS = {"page": "page_id", "linktarget": "target_id", "redirect": "source"}


def sql_tuples(line: str) -> Iterator[list[str | None]]:
    """Tuples of an INSERT line. Backslash escapes count, doubled quotes do not; a broken tuple ends the line."""
    at = line.find("VALUES")
    i, n = (at + 6 if at >= 0 else len(line)), len(line)
    while (i := line.find("(", i)) >= 0:
        i += 1
        row: list[str | None] = []
        while i < n:
            while i < n and line[i] in " \t":
                i += 1
            if i < n and line[i] == "'":
                parts, i = [], i + 1
                while True:
                    quote, slash = line.find("'", i), line.find("\\", i)
                    if quote < 0:
                        return
                    if 0 <= slash < quote:
                        parts.append(line[i:slash])
                        parts.append(_ESCAPES.get(line[slash + 1], line[slash + 1]))
                        i = slash + 2
                    else:
                        parts.append(line[i:quote])
                        i = quote + 1
                        break
                row.append("".join(parts))
            else:
                end = i
                while end < n and line[end] not in ",)":
                    end += 1
                word = line[i:end].strip()
                row.append(None if word.upper() == "NULL" else word)
                i = end
            while i < n and line[i] not in ",)":
                i += 1
            if i >= n:
                return
            i += 1
            if line[i - 1] == ")":
                break
        yield row


def _parsed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows: list[list[str | None]] = []
        for line in batch["value"]:  # a line holds a megabyte of tuples at most
            rows += sql_tuples(line)
            if len(rows) >= _TUPLES:
                yield pd.DataFrame({"c": rows})
                rows = []
        if rows:
            yield pd.DataFrame({"c": rows})


def read_sql(spark: SparkSession, path, table: str) -> DataFrame:
    """Rows of a dump table; a row whose numbers cannot be read is dropped. Of rows with one key, the first stays."""
    lines = spark.read.option("lineSep", "\n").text(path).where(F.col("value").startswith("INSERT INTO"))
    cells = lines.select("value").mapInPandas(_parsed, "c array<string>").withColumn("ord", F.monotonically_increasing_id())
    out = [F.try_element_at("c", F.lit(i + 1)).try_cast(kind).alias(name) for i, name, kind in TABLES[table]]
    rows = cells.select(*out, "ord").dropna(subset=[name for _, name, kind in TABLES[table] if kind != "string"])
    if table == "page":
        rows = rows.withColumn("title", spaced(F.col("title")))
    if key := _KEYS.get(table):
        rest = [c for c in rows.columns if c not in (key, "ord")]
        rows = rows.groupBy(key).agg(F.min_by(F.struct(*rest), "ord").alias("_r")).select(key, "_r.*")
        return rows.select(*[name for _, name, _ in TABLES[table]])
    return rows.drop("ord")


_NDJSON = "identifier bigint, name string, url string, date_modified string, version struct<identifier:bigint>, article_body struct<html:string>"


def read_ndjson(spark: SparkSession, path, targets: DataFrame | None = None) -> DataFrame:
    """page_id, revision_id, title, url, html, date_modified; pages without id and broken lines go (``broken_ndjson`` has them)."""
    rows = spark.read.schema(_NDJSON).option("mode", "DROPMALFORMED").json(path).where("identifier is not null")
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    rows = rows.select(
        F.col("identifier").alias("page_id"),
        F.coalesce("version.identifier", F.lit(0)).alias("revision_id"),
        text("name").alias("title"),
        text("url").alias("url"),
        text("article_body.html").alias("html"),
        text("date_modified").alias("date_modified"),
    )
    return rows if targets is None else rows.join(targets.select("page_id").distinct(), "page_id", "left_semi")


def broken_ndjson(spark: SparkSession, path) -> DataFrame:
    """file, line, reason of the lines that ``read_ndjson`` leaves out."""
    lines = spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("file"), "value").where(F.length(F.trim("value")) > 0)
    parsed = lines.withColumn("_r", F.from_json("value", f"{_NDJSON}, _bad string", {"columnNameOfCorruptRecord": "_bad"}))
    reason = F.when(F.col("_r._bad").isNotNull(), "broken").when(F.col("_r.identifier").isNull(), "no id")
    return parsed.withColumn("reason", reason).where(F.col("reason").isNotNull()).select("file", F.col("value").alias("line"), "reason")


_XML_OPTIONS = {"rowTag": "page", "ignoreSurroundingSpaces": "false", "ignoreCorruptFiles": "true"}
_XML = "id bigint, ns int, title string, revision array<struct<id:bigint,text:string>>"


def read_xml(spark: SparkSession, path, targets: DataFrame | None = None, namespace: int = 0) -> DataFrame:
    """page_id, revision_id, title, wikitext (of the first revision; empty if missing).

    Of a file that breaks off, the pages before the break are read; ``broken_xml`` names such files.
    """
    rows = spark.read.format("xml").schema(_XML).options(**_XML_OPTIONS).load(path).where((F.col("ns") == namespace) & F.col("id").isNotNull())
    rows = rows.select(
        F.col("id").alias("page_id"),
        F.coalesce(F.try_element_at("revision", F.lit(1))["id"], F.lit(0)).alias("revision_id"),
        "title",
        F.coalesce(F.try_element_at("revision", F.lit(1))["text"], F.lit("")).alias("wikitext"),
    )
    return rows if targets is None else rows.join(targets.select("page_id").distinct(), "page_id", "left_semi")


def broken_xml(spark: SparkSession, path) -> DataFrame:
    """file, pages, read: XML files without the end of their root (cut short, unreadable), or of which not all pages are read."""
    plain = F.regexp_replace("file", "^file:/+", "/").alias("file")
    listed = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file")).select(plain)
    here = F.col("_metadata.file_path").alias("file")
    lines = spark.read.option("ignoreCorruptFiles", "true").option("lineSep", "\n").text(path).select(here, "value")
    seen = lines.groupBy(plain).agg(F.sum(F.regexp_count("value", F.lit("<page[ >]"))).alias("pages"), F.bool_or(F.col("value").contains("</mediawiki>")).alias("_ended"))
    rows = spark.read.format("xml").schema(_XML).options(**_XML_OPTIONS).load(path).select(here, "id").where("id is not null")
    read = rows.groupBy(plain).agg(F.count(F.lit(1)).alias("read"))
    both = listed.join(seen, "file", "left").join(read, "file", "left").fillna({"pages": 0, "read": 0, "_ended": False})
    return both.where("not _ended or pages != read").select("file", "pages", "read")


def snapshot(pages: DataFrame, html: DataFrame, xml: DataFrame, links: DataFrame, targets: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """page_id, title, resolved_id, html, wikitext, categories of every page, redirects followed first if they are given.

    ``redirects``: source, resolved. A page that does not exist where it leads has null html and wikitext.
    """
    own = pages.select("page_id", "title")
    led = context.follow(own.withColumn("asked", F.col("page_id")), redirects) if redirects is not None else own.withColumn("asked", F.col("page_id"))
    led = led.select(F.col("asked"), F.col("title"), F.col("page_id"))
    out = led.join(html.select("page_id", "html"), "page_id", "left").join(xml.select("page_id", "wikitext"), "page_id", "left")
    out = context.with_categories(out, links.select("page_id", "target_id"), targets)
    return out.select(F.col("asked").alias("page_id"), "title", F.col("page_id").alias("resolved_id"), "html", "wikitext", "categories")


def find_page(pages: DataFrame, term: str, namespace: int = 0) -> DataFrame:
    """The page with that title, else the first by title that begins with it."""
    own = pages.where(F.col("namespace") == namespace).where(F.col("title").startswith(term))
    return own.orderBy((F.col("title") == term).desc(), "title", "page_id").limit(1)
