"""Page scheduling as a keyed stream: emit on first sight, and once more when context first arrives."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ITEM = "page_id long, ord long, has_context boolean"


class _Schedule(StatefulProcessor):
    """State: whether the page had context when last emitted. It never expires; one boolean a page."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "has_context boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        """At most two rows of a key are emitted: its first, and its first with context. Only these two are kept meanwhile."""
        had = self.seen.get()[0] if self.seen.exists() else None
        first = context = None  # the least ord of all, and of those with context
        for part in rows:
            with_context = part.loc[part["has_context"].astype(bool), "ord"]
            i = part["ord"].idxmin()
            one = (int(part.at[i, "ord"]), bool(part.at[i, "has_context"]))
            first = one if first is None else min(first, one)
            if len(with_context):
                context = int(with_context.min()) if context is None else min(context, int(with_context.min()))
        out = [(key[0], *first)] if had is None and first else []
        if context is not None and not had and not (out and first[1]):
            out.append((key[0], context, True))
        if out:
            self.seen.update((bool(had) or context is not None,))
        yield pd.DataFrame(out, columns=["page_id", "ord", "has_context"])

    def close(self) -> None:
        pass


def schedule_stream(items: DataFrame) -> DataFrame:
    """items: a stream of page_id, ord, has_context. Needs the RocksDB state store."""
    return items.groupBy("page_id").transformWithStateInPandas(
        statefulProcessor=_Schedule(), outputStructType=ITEM, outputMode="Append", timeMode="None"
    )


def schedule_batch(items: DataFrame) -> DataFrame:
    """The same rows over a table: the first of a page and, if it had no context, the first later one with it."""
    page = Window.partitionBy("page_id").orderBy("ord")
    seen = items.withColumn("_n", F.row_number().over(page))
    before = F.max(F.col("has_context").cast("int")).over(page.rowsBetween(Window.unboundedPreceding, -1))
    kept = seen.withColumn("_had", F.coalesce(before, F.lit(0)))
    return kept.where((F.col("_n") == 1) | (F.col("has_context") & (F.col("_had") == 0))).select("page_id", "ord", "has_context")


#: Changes that are kept apart before they are merged into one base.
COMPACT = 8


def upsert_index(batch: DataFrame, path: str, batch_id: int | None = None) -> None:
    """foreachBatch sink: the index at ``path`` with the batch's rows replacing those of the same page.

    A batch writes only its own rows, as ``delta-<id>``; a version counts once its _SUCCESS file is there, which Spark
    writes last, so a crash leaves the version before. A batch that runs again writes the same version again. Every
    ``COMPACT`` versions all is merged into ``base-<id>``, and what the base before it made needless goes.
    """
    spark = batch.sparkSession
    found = _versions(spark, path)
    version = batch_id if batch_id is not None else max([v for _, v in found], default=-1) + 1
    newest = Window.partitionBy("page_id").orderBy(F.desc("ord"))
    rows = batch.withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n")
    rows.write.mode("overwrite").parquet(f"{path}/delta-{version:012d}")
    base = max([v for kind, v in found if kind == "base" and v < version], default=-1)
    if sum(kind == "delta" and v > base for kind, v in {*found, ("delta", version)}) > COMPACT:
        read_index(spark, path, version).write.mode("overwrite").parquet(f"{path}/base-{version:012d}")
        for kind, v in found:
            if v < base or (kind == "delta" and v <= base):
                fs, p = _hadoop(spark, f"{path}/{kind}-{v:012d}")
                fs.delete(p, True)


def _hadoop(spark, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _versions(spark, path: str) -> list[tuple[str, int]]:
    """Kind and number of the versions that are complete."""
    fs, p = _hadoop(spark, f"{path}/*-*/_SUCCESS")
    names = [s.getPath().getParent().getName() for s in fs.globStatus(p) or []]
    return sorted((kind, int(number)) for kind, number in (n.split("-") for n in names))


def read_index(spark, path: str, upto: int | None = None) -> DataFrame | None:
    """The newest row of each page; None where nothing is written yet."""
    found = [(kind, v) for kind, v in _versions(spark, path) if upto is None or v <= upto]
    base = max([v for kind, v in found if kind == "base"], default=-1)
    parts = [("base", base)] * (base >= 0) + [(kind, v) for kind, v in found if kind == "delta" and v > base]
    if not parts:
        return None
    frames = [spark.read.parquet(f"{path}/{kind}-{v:012d}").withColumn("_version", F.lit(v)) for kind, v in parts]
    every = reduce(DataFrame.unionByName, frames)
    newest = Window.partitionBy("page_id").orderBy(F.desc("_version"))
    return every.withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n", "_version")


def rate(events: DataFrame, key: str, seconds: int) -> DataFrame:
    """Adds in_window: events of the key in the last ``seconds``, this one included."""
    micros = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts)")
    span = Window.partitionBy(key).orderBy(micros).rangeBetween(-seconds * 1_000_000, 0)
    return events.withColumn("in_window", F.count(F.lit(1)).over(span))


def tumbling(events: DataFrame, width: str = "1 hour") -> DataFrame:
    """Extension: counts by type and window; on a stream, set a watermark on ts first."""
    return events.groupBy(F.window("ts", width), "event_type").agg(F.count(F.lit(1)).alias("n"))


def sessions(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """Extension: sessions by user."""
    return events.groupBy(F.session_window("ts", gap), "user_id").agg(F.count(F.lit(1)).alias("n"))
