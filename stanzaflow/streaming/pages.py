"""Pages as a stream: files in, classified pages to an index and to JSON lines, what collections name to a work table.

The source is bounded a micro-batch (``maxFilesPerTrigger``), so a slow sink holds the source back. The stream's checkpoint
says which files are done: a run that is stopped goes on where it was, and a batch that runs again writes what it wrote
before, since every sink keeps a batch under its own id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import markup
from ..sources import dumps
from . import schedule


def read_pages(spark: SparkSession, path: str, files: int = 1) -> DataFrame:
    """A stream of page_id, title, html from NDJSON files, ``files`` of them a micro-batch."""
    rows = spark.readStream.schema(dumps._NDJSON).option("maxFilesPerTrigger", files).option("mode", "DROPMALFORMED").json(path)
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    return rows.where("identifier is not null").select(F.col("identifier").alias("page_id"), text("name").alias("title"), text("article_body.html").alias("html"))


def named_titles(pages: DataFrame) -> DataFrame:
    """title, has_context: what collections and hubs among the classified pages name."""
    items = pages.where("type = 'POETIC_COLLECTION'").select(F.explode("parsed.items").alias("i")).where("i.kind = 'POEM'")
    versions = pages.where("type = 'MULTI_VERSION_HUB'").select(F.explode("parsed.sub_titles").alias("title"))
    both = items.select(F.col("i.title").alias("title"), F.lit(True).alias("has_context")).unionByName(versions.select("title", F.lit(False).alias("has_context")))
    return both.groupBy("title").agg(F.max("has_context").alias("has_context"))


def run(pages: DataFrame, out: str, checkpoint: str, lang: str = "fr") -> StreamingQuery:
    """Start the stream over what is there now. Below ``out``: ``index`` (versions), ``poems`` and ``work`` (a folder a batch).

    ``work`` holds the titles to look at next, for ``context.resolve`` and ``context.pending``: the feedback of a batch
    is input of a later run, never of the batch itself.
    """

    def batch(rows: DataFrame, number: int) -> None:
        ready = rows.withColumn("namespace", F.lit(0)).withColumn("categories", F.array().cast("array<string>"))
        typed = markup.classify(ready, lang).persist()
        try:
            kept = typed.select("page_id", "title", "type", "reason", F.lit(number).cast("long").alias("ord"))
            schedule.upsert_index(kept, f"{out}/index", number)
            poems = typed.where("type = 'POEM'").select("page_id", "title", markup.stanzas(F.col("parsed")).alias("stanzas"))
            poems.write.mode("overwrite").json(f"{out}/poems/batch={number}")
            named_titles(typed).write.mode("overwrite").json(f"{out}/work/batch={number}")
        finally:
            typed.unpersist()

    return pages.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
