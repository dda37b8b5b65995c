"""Connected components over a table of links, without collecting them.

Alternating large-star and small-star steps (Kiveris et al., "Connected
Components in MapReduce and Beyond", 2014): every step is one grouped minimum
with map-side combining and one equi-join, and the number of steps grows with
the logarithm of the size. Each step ends in a reliable checkpoint. The minima
are checkpointed before they are joined, so that both sides of the join are
plain exchanges and adaptive execution can split the rows of a hub.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage


def _least(links: DataFrame) -> DataFrame:
    return cut_lineage(links.groupBy("u").agg(F.min("v").alias("m")))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u and v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """links: u above v."""
    least = _least(links)
    moved = links.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Columns node, label for each node that has a link; label is the smallest node it reaches."""
    links = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct()
    links = cut_lineage(links)
    before = None
    while (now := _state(links)) != before:
        before = now
        links = cut_lineage(_small_star(_large_star(links).distinct()).distinct())
    roots = links.select(F.col("v").alias("node")).distinct().withColumn("label", F.col("node"))
    return links.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)
