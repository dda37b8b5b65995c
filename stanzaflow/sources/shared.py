"""The folder that driver and executors share, and temporary files in it."""

from __future__ import annotations

import atexit
import re
import uuid

from pyspark.sql import SparkSession

_DEFAULT_DIR = "/tmp/checkpoints/stanzaflow"


def shared_dir(spark: SparkSession) -> str:
    """What ``spark.checkpoint.dir`` names, else the context's checkpoint folder; only a session of one process gets a default."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    known = spark.sparkContext._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return known.get()
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    spark.sparkContext.setCheckpointDir(_DEFAULT_DIR)
    return _DEFAULT_DIR


def temporary(spark: SparkSession) -> str:
    """A new path in the shared folder; what is written there is deleted when the driver ends."""
    path = f"{shared_dir(spark).rstrip('/')}/files-{uuid.uuid4().hex}"

    def drop() -> None:
        try:
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # the session is gone: nothing is left to delete with
            pass

    atexit.register(drop)
    return path
