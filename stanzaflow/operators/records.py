"""Record operators: dedup, merge, enrichment, diff, validation.

``ord`` is any orderable column (a number, or the struct the readers attach)
that gives the records of a corpus their order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schema
from ..functions import text as t

STRATEGIES = ("keep_a", "keep_b", "keep_richest")


def _by_page():
    return Window.partitionBy("page_id")


def _pick(records: DataFrame, *order: Column) -> DataFrame:
    ranked = records.where(F.col("page_id").isNotNull()).withColumn("_rank", F.row_number().over(_by_page().orderBy(*order)))
    return ranked.where("_rank = 1").drop("_rank")


def first_wins(records: DataFrame) -> DataFrame:
    return _pick(records, F.asc("ord"))


def last_wins(records: DataFrame) -> DataFrame:
    return _pick(records, F.desc("ord"))


def process(records: DataFrame) -> DataFrame:
    """Clean the title; a legacy licence field goes."""
    out = records.withColumn("title", t.clean_title(F.col("title")))
    return out.withColumn("metadata", F.col("metadata").dropFields("license_name"))


def best_version(records: DataFrame) -> DataFrame:
    """Per page the first record with a collection, else the first; ``first_ord`` is where the page first stands."""
    placed = records.withColumn("first_ord", F.min("ord").over(_by_page()))
    return _pick(placed, F.col("collection_page_id").isNull().asc(), F.asc("ord"))


def clean_counters(records: DataFrame) -> DataFrame:
    counts = records.agg(F.count(F.lit(1)).alias("read"), F.countDistinct("page_id").alias("written"))
    return counts.select("read", (F.col("read") - F.col("written")).alias("removed"), "written")


def _sided(a: DataFrame, b: DataFrame) -> DataFrame:
    both = a.withColumn("src", F.lit("A")).unionByName(b.withColumn("src", F.lit("B")), allowMissingColumns=True)
    both = both.where(F.col("page_id").isNotNull()).withColumn("score", t.richness())
    last_a = F.max(F.when(F.col("src") == "A", F.col("ord"))).over(_by_page())
    return both.withColumn("_candidate", (F.col("src") == "B") | (F.col("ord") == last_a))


def merge(a: DataFrame, b: DataFrame, strategy: str = "keep_richest") -> DataFrame:
    """One record per page of either side; adds src, score, first_src and first_ord (the output order).

    All windows share one exchange by page_id.
    """
    orders = {
        "keep_a": [F.asc("src"), F.asc("ord")],
        "keep_b": [F.desc("src"), F.desc("ord")],
        "keep_richest": [F.desc("score"), F.asc("src"), F.asc("ord")],
    }
    both = _sided(a, b).withColumn("_first", F.min(F.struct("src", "ord")).over(_by_page())).where("_candidate")
    won = _pick(both, *orders[strategy])
    return won.withColumn("first_src", F.col("_first.src")).withColumn("first_ord", F.col("_first.ord")).drop("_first", "_candidate")


def merge_counters(a: DataFrame, b: DataFrame, strategy: str = "keep_richest") -> DataFrame:
    both = _sided(a, b)
    earlier = _by_page().orderBy("src", "ord").rowsBetween(Window.unboundedPreceding, -1)
    both = both.withColumn("_n", F.count(F.when(F.col("_candidate"), 1)).over(earlier))
    both = both.withColumn("_best", F.max(F.when(F.col("_candidate"), F.col("score"))).over(earlier))
    again = (F.col("src") == "B") & (F.col("_n") > 0)
    wins = {"keep_a": F.lit(False), "keep_b": again, "keep_richest": again & (F.col("score") > F.col("_best"))}[strategy]

    def number(c: Column) -> Column:
        return F.coalesce(F.sum(c.cast("long")), F.lit(0).cast("long"))

    counts = both.agg(
        number(F.col("src") == "A").alias("total_a"),
        number(F.col("src") == "B").alias("total_b"),
        number(again).alias("duplicates"),
        number(wins).alias("b_wins"),
    )
    return counts.withColumn("a_wins", F.col("duplicates") - F.col("b_wins"))


def dropped_counts(a: DataFrame, b: DataFrame) -> DataFrame:
    """What ``merge`` leaves out of each side for want of a page id."""
    count = lambda records, name: records.agg(F.count_if(F.col("page_id").isNull()).alias(name))
    return count(a, "dropped_a").crossJoin(count(b, "dropped_b"))  # one row each


def build_index(records: DataFrame, path: str) -> None:
    """The whole index in one write: of records of one page the first."""
    index_rows(first_wins(records)).write.mode("overwrite").parquet(path)


def unidentified(records: DataFrame) -> DataFrame:
    """Records with a collection title (empty counts) but no collection id (0 is one)."""
    return records.where("collection_title is not null and collection_page_id is null")


def index_rows(records: DataFrame) -> DataFrame:
    nested = {"author", "publication_date"}
    return records.select(*[F.col(f"metadata.{c}").alias(c) if c in nested else F.col(c) for c in schema.INDEX_COLUMNS])


# -- enrichment ---------------------------------------------------------------------------------------


def title_ids(records: DataFrame) -> DataFrame:
    """collection_title, known_id: the id first seen with each title."""
    known = records.where(t.truthy(F.col("collection_title")) & F.col("collection_page_id").isNotNull())
    return known.groupBy("collection_title").agg(F.min_by("collection_page_id", "ord").alias("known_id"))


def missing_titles(records: DataFrame) -> DataFrame:
    """Titles without an id anywhere."""
    lacking = records.where(t.truthy(F.col("collection_title")) & F.col("collection_page_id").isNull())
    return lacking.select("collection_title").distinct().join(title_ids(records), "collection_title", "left_anti")


def enrich(records: DataFrame, lookup: DataFrame | None = None) -> DataFrame:
    """Fill missing collection ids from titles seen with one, then from ``lookup`` (collection_title, known_id)."""
    known = title_ids(records)
    if lookup is not None:
        known = known.unionByName(lookup.join(known, "collection_title", "left_anti"))
    joined = records.join(known, "collection_title", "left").withColumn("collection_page_id", F.coalesce("collection_page_id", "known_id"))
    return joined.select(*records.columns)


def enrich_counters(records: DataFrame) -> DataFrame:
    """Titles known, titles to fetch, records that ``enrich`` fills."""
    lacking = t.truthy(F.col("collection_title")) & F.col("collection_page_id").isNull()
    filled = records.where(lacking).join(title_ids(records), "collection_title").agg(F.count(F.lit(1)).alias("enriched"))
    cached = title_ids(records).agg(F.count(F.lit(1)).alias("cached"))
    return cached.crossJoin(missing_titles(records).agg(F.count(F.lit(1)).alias("to_fetch"))).crossJoin(filled)  # one row each


# -- diff ----------------------------------------------------------------------------------------------

DIFF_FIELDS = {
    "title": "title",
    "metadata.author": "metadata.author",
    "metadata.publication_date": "metadata.publication_date",
    "collection_title": "collection_title",
    "section_title": "section_title",
    "poem_order": "poem_order",
    "checksum_sha256": "checksum_sha256",
}


def _falsy_null(c: Column, name: str) -> Column:
    out = F.nullif(c.cast("string"), F.lit(""))
    return F.nullif(out, F.lit("0")) if name == "poem_order" else out


def diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """page_id, status (added, removed, modified, same), changes: array of (field, before, after).

    The last record of a page on each side counts; empty text and order 0 equal null.
    """

    def side(records: DataFrame, name: str) -> DataFrame:
        fields = F.struct(*[_falsy_null(F.col(c), n).alias(n.replace(".", "_")) for n, c in DIFF_FIELDS.items()])
        return last_wins(records).select("page_id", fields.alias(name))

    both = side(a, "a").join(side(b, "b"), "page_id", "full_outer")
    pairs = [
        F.struct(F.lit(n).alias("field"), F.col(f"a.{n.replace('.', '_')}").alias("before"), F.col(f"b.{n.replace('.', '_')}").alias("after"))
        for n in DIFF_FIELDS
    ]
    changed = F.filter(F.array(*pairs), lambda x: ~x["before"].eqNullSafe(x["after"]))
    status = F.when(F.col("a").isNull(), "added").when(F.col("b").isNull(), "removed").when(F.size(changed) > 0, "modified").otherwise("same")
    both = both.withColumn("status", status)
    return both.select("page_id", "status", F.when(F.col("status") == "modified", changed).alias("changes"))


def diff_summary(found: DataFrame) -> DataFrame:
    """Counts by status, and of the pages on each side."""
    counts = [F.count_if(F.col("status") == s).alias(s) for s in ("added", "removed", "modified")]
    total = [F.count_if(F.col("status") != "added").alias("total_a"), F.count_if(F.col("status") != "removed").alias("total_b")]
    return found.agg(*counts, *total)


# -- validation ----------------------------------------------------------------------------------------


def judged(lines: DataFrame, column: str = "value") -> DataFrame:
    """Adds state (blank, bad_json, invalid, valid) and the fields that break a rule."""
    text = t.strip(F.col(column))
    parsed = lines.withColumn("_v", F.try_parse_json(F.when(F.length(text) > 0, text)))
    parsed = parsed.withColumn("problems", schema.problems(F.col("_v")))
    state = F.when(F.coalesce(F.length(text), F.lit(0)) == 0, "blank").when(F.col("_v").isNull(), "bad_json")
    state = state.when(F.size("problems") > 0, "invalid").otherwise("valid")
    return parsed.withColumn("state", state).drop("_v")


def validation_counts(lines: DataFrame, column: str = "value") -> DataFrame:
    """total (blank lines included), valid, errors."""
    return judged(lines, column).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("state") == "valid").alias("valid"),
        F.count_if(F.col("state").isin("bad_json", "invalid")).alias("errors"),
    )


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), frames)
