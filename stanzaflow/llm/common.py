"""Helpers shared by the operators: scratch tables and whole-text columns."""

from __future__ import annotations

import atexit
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_DEFAULT_DIR = "/tmp/checkpoints/stanzaflow"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    ``spark.checkpoint.dir`` names it on a cluster; only where that setting and
    the context's own checkpoint folder are unset and all runs in one process
    (tests) is a default set.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
        if known.isDefined():
            return known.get()
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = _DEFAULT_DIR
        spark.sparkContext.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder; survives lost executors.

    For small tables (a few columns a row): Spark deletes the files once the
    DataFrame is collected as garbage, if the cluster sets
    ``spark.cleaner.referenceTracking.cleanCheckpoints``.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


class Scratch:
    """Parquet tables in the shared folder for large intermediate results."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_dir(spark).rstrip('/')}/stanzaflow-{uuid.uuid4().hex}"
        atexit.register(self.drop)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Write and read again. Lineage ends here, so the shuffle files behind ``df`` go at once."""
        path = f"{self.root}/{name}"
        before = self.spark.conf.get(_CLEANUP, None)
        self.spark.conf.set(_CLEANUP, "true")
        try:
            df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        finally:
            if before is None:
                self.spark.conf.unset(_CLEANUP)
            else:
                self.spark.conf.set(_CLEANUP, before)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str = "") -> None:
        """Delete one table, or all."""
        try:
            jvm = self.spark.sparkContext._jvm
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        except Exception:  # the session is gone: nothing is left to delete with
            if name:
                raise


def whole_text(name: str = "text"):
    """A text column in which null counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def word_count(column):
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text, null counting as 0."""
    return F.coalesce(F.regexp_count(column, F.lit(_WORD)), F.lit(0)).cast("long")
