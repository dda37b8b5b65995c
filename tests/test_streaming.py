"""The schedule as a stream gives what its batch twin gives; the index sink can be run again."""

import json
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stanzaflow.streaming import pages, schedule

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@pytest.fixture
def items(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select(F.col("user_id").alias("page_id"), F.col("event_id").alias("ord"), (F.col("event_type") == "purchase").alias("has_context"))


def test_stream_equals_batch(spark, items, tmp_path):
    for k in range(3):  # three files, three micro-batches, in order of ord
        items.where(f"ord div 400 = {k}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    old = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    try:
        stream = spark.readStream.schema(schedule.ITEM).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        sink = schedule.schedule_stream(stream).writeStream.format("parquet").option("path", str(tmp_path / "out"))
        sink.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination(180)
    finally:
        if old:
            spark.conf.set("spark.sql.streaming.stateStore.providerClass", old)
        else:
            spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    got = Counter(map(tuple, spark.read.parquet(str(tmp_path / "out")).select("page_id", "ord", "has_context").collect()))
    assert got == Counter(map(tuple, schedule.schedule_batch(items).select("page_id", "ord", "has_context").collect()))


def test_upsert(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(schedule, "COMPACT", 3)
    path = str(tmp_path / "index")
    rows = lambda *x: spark.createDataFrame(list(x), "page_id long, ord long, title string")
    shown = lambda: sorted(map(tuple, schedule.read_index(spark, path).select("page_id", "title").collect()))
    assert schedule.read_index(spark, path) is None
    schedule.upsert_index(rows((1, 1, "a"), (1, 2, "b"), (2, 1, "c")), path, 0)
    for _ in range(2):  # the same batch again gives the same index
        schedule.upsert_index(rows((2, 0, "d"), (3, 1, "e")), path, 1)
        assert shown() == [(1, "b"), (2, "d"), (3, "e")]
    # a version that broke off before its end does not count
    rows((1, 9, "broken")).write.parquet(f"{path}/delta-{2:012d}")
    (tmp_path / "index" / f"delta-{2:012d}" / "_SUCCESS").unlink()
    assert shown() == [(1, "b"), (2, "d"), (3, "e")]
    for n in range(2, 12):
        schedule.upsert_index(rows((3, 0, f"e{n}"), (n + 100, 0, "new")), path, n)
        assert shown()[:3] == [(1, "b"), (2, "d"), (3, f"e{n}")] and len(shown()) == n + 2
    kept = [p.name for p in (tmp_path / "index").iterdir()]
    assert len(kept) <= 2 * schedule.COMPACT + 4
    schedule.upsert_index(rows((1, 0, "z")), path)
    assert shown()[0] == (1, "z")


def page_file(path, *pages):
    lines = [json.dumps({"identifier": i, "name": t, "article_body": {"html": h}}) for i, t, h in pages]
    path.write_text("\n".join([*lines, "{broken"]))


def test_pages_as_a_stream(spark, tmp_path):
    """Three files in three micro-batches; a later run takes only what is new, and a page that comes again replaces its row."""
    source, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    source.mkdir()
    book = '<div id="toc"></div><div class="mw-parser-output"><ul><li><a href="/wiki/A">x</a></li><li><b>Part</b></li></ul></div>'
    page_file(source / "1.json", (1, "A", "<poem>a\nb</poem>"), (2, "Book", book))
    page_file(source / "2.json", (3, "Hub", '<a title="d:Q1">w</a><div class="ws-summary"></div><a href="/wiki/Hub_(v)">v</a>'))
    page_file(source / "3.json", (1, "A", "<p>gone</p>"))
    for name, when in (("1", 1), ("2", 2), ("3", 3)):
        os.utime(source / f"{name}.json", (when, when))
    run = lambda: pages.run(pages.read_pages(spark, str(source)), out, checkpoint).awaitTermination(180)
    shown = lambda: sorted((r["page_id"], r["type"], r["ord"]) for r in schedule.read_index(spark, f"{out}/index").collect())
    run()
    assert shown() == [(1, "OTHER", 2), (2, "POETIC_COLLECTION", 0), (3, "MULTI_VERSION_HUB", 1)]
    assert [r["stanzas"] for r in spark.read.json(f"{out}/poems/batch=0").collect()] == [[["a", "b"]]]
    work = spark.read.json(f"{out}/work").select("title", "has_context")
    assert sorted(map(tuple, work.collect())) == [("A", True), ("Hub (v)", False)]
    page_file(source / "4.json", (4, "D", "<poem>d</poem>"))
    run()
    assert shown() == [(1, "OTHER", 2), (2, "POETIC_COLLECTION", 0), (3, "MULTI_VERSION_HUB", 1), (4, "POEM", 3)]
