"""The driver's queries over its tables, each with its SQL where SQL can say it.

``corpus`` derives records from documents so that ids collide within and across
two sides, ids are 0, texts blank, and titles hold slashes and parentheses.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import links, text
from ..operators import context, graph, profile, records, views
from ..streaming import schedule

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


_FIELDS = {
    "page_id": ("doc_id div 4", "doc_id // 4"),
    "ord": ("doc_id", "doc_id"),
    "src": ("case when doc_id % 3 = 0 then 'B' else 'A' end",) * 2,
    "title": ("concat(lang, '/', source, ' (v', doc_id % 3, ')')",) * 2,
    "language": ("lang", "lang"),
    "author": ("case when doc_id % 7 != 0 then source end",) * 2,
    "publication_date": ("case when doc_id % 4 = 0 then cast(1800 + doc_id % 100 as string) end",) * 2,
    "publisher": ("case when doc_id % 9 = 0 then '  ' when doc_id % 5 = 0 then concat('P', doc_id % 3) end",) * 2,
    "translator": ("case when doc_id % 6 = 1 then 'T' end",) * 2,
    "source_collection": ("case when doc_id % 2 = 0 then concat('r', doc_id % 15) end",) * 2,
    "collection_page_id": ("case when doc_id % 3 != 1 then doc_id % 20 end",) * 2,
    "collection_title": ("case when doc_id % 11 != 0 then concat('c', doc_id % 25) end",) * 2,
    "section_title": ("case when doc_id % 5 = 0 then concat('s', doc_id % 10) end",) * 2,
    "poem_order": ("case when doc_id % 13 != 0 then cast(doc_id % 6 as int) end",) * 2,
    "hub_page_id": ("doc_id div 4 + case when doc_id % 10 = 0 then 1 else 0 end", "doc_id // 4 + case when doc_id % 10 = 0 then 1 else 0 end"),
    "hub_title": ("case when doc_id % 6 = 0 then concat('h', (doc_id div 4) % 7) end", "case when doc_id % 6 = 0 then concat('h', (doc_id // 4) % 7) end"),
    "normalized_text": ("text", "text"),
    "checksum_sha256": ("sha2(text, 256)", "sha256(text)"),
}
_META = ("author", "publication_date", "source_collection", "publisher", "translator")


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = table(spark, sf_dir, "documents").select(*[F.expr(s).alias(k) for k, (s, _) in _FIELDS.items()])
    nested = F.struct(*[F.col(m) for m in _META])
    stanzas = F.struct(F.array(F.split("normalized_text", "\n")).alias("stanzas"))
    return flat.withColumn("metadata", nested).withColumn("structure", stanzas).drop(*_META)


def sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = corpus(spark, sf_dir)
    return rows.where("src = 'A'").drop("src"), rows.where("src = 'B'").drop("src")


_C = "corpus AS (SELECT " + ", ".join(f"{s} AS {k}" for k, (_, s) in _FIELDS.items()) + " FROM documents)"
_BLANK = " + ".join(f"(CASE WHEN length(trim(coalesce({m}, ''))) > 0 THEN 10 ELSE 0 END)" for m in _META)
_SCORE = (
    "((CASE WHEN collection_page_id IS NOT NULL THEN 50 ELSE 0 END) + (CASE WHEN section_title IS NOT NULL THEN 20 ELSE 0 END)"
    f" + (CASE WHEN hub_page_id IS DISTINCT FROM page_id THEN 30 ELSE 0 END) + {_BLANK} + length(normalized_text) // 100)::BIGINT"
)
_SCORED = f"{_C}, scored AS (SELECT *, {_SCORE} AS score FROM corpus)"
_CAND = (
    f"{_SCORED}, cand AS (SELECT *, src = 'B' OR ord = max(CASE WHEN src = 'A' THEN ord END) OVER (PARTITION BY page_id) AS candidate FROM scored)"
)


def _with(body: str) -> str:
    return f"WITH {_C} {body}"


# -- dedup and merge -------------------------------------------------------------------------------------


@query(f"WITH {_SCORED} SELECT ord, page_id, score FROM scored")
def richness_score(spark, sf_dir):
    return corpus(spark, sf_dir).select("ord", "page_id", text.richness().alias("score"))


def _merge(name: str, order: str) -> None:
    def run(spark, sf_dir):
        return records.merge(*sides(spark, sf_dir), name).select("page_id", "src", "ord", "score", "title", "first_src", "first_ord")

    run.__name__ = f"merge_{name}"
    query(
        f"WITH {_CAND}, firsts AS (SELECT page_id, min(src) AS first_src, arg_min(ord, (src, ord)) AS first_ord FROM corpus GROUP BY page_id), "
        f"ranked AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY {order}) AS n FROM cand WHERE candidate) "
        "SELECT page_id, src, ord, score, title, first_src, first_ord FROM ranked JOIN firsts USING (page_id) WHERE n = 1"
    )(run)


_merge("keep_richest", "score DESC, src, ord")
_merge("keep_a", "src, ord")
_merge("keep_b", "src DESC, ord DESC")


def _merge_counters(name: str, wins: str) -> None:
    def run(spark, sf_dir):
        return records.merge_counters(*sides(spark, sf_dir), name)

    run.__name__ = f"merge_counters_{name}"
    query(
        f"WITH {_CAND}, run AS (SELECT *, src = 'B' AND count(*) FILTER (WHERE candidate) OVER w > 0 AS again, "
        "max(score) FILTER (WHERE candidate) OVER w AS best FROM cand "
        "WINDOW w AS (PARTITION BY page_id ORDER BY src, ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), "
        "n AS (SELECT count(*) FILTER (WHERE src = 'A') AS total_a, count(*) FILTER (WHERE src = 'B') AS total_b, "
        f"count(*) FILTER (WHERE again) AS duplicates, count(*) FILTER (WHERE again AND {wins}) AS b_wins FROM run) "
        "SELECT *, duplicates - b_wins AS a_wins FROM n"
    )(run)


_merge_counters("keep_richest", "score > best")
_merge_counters("keep_a", "false")
_merge_counters("keep_b", "true")

_TITLE_SQL = (
    "coalesce(nullif(trim(regexp_replace(regexp_replace(list_extract(string_split({0}, '/'), -1), '\\s*\\([^)]*\\)', '', 'g'), "
    "'\\s+', ' ', 'g')), ''), trim({0}))"
)


@query(
    f"WITH {_C}, ranked AS (SELECT *, min(ord) OVER (PARTITION BY page_id) AS first_ord, row_number() OVER (PARTITION BY page_id "
    f"ORDER BY collection_page_id IS NULL, ord) AS n FROM corpus) SELECT page_id, ord, {_TITLE_SQL.format('title')} AS title, collection_page_id, first_ord FROM ranked WHERE n = 1"
)
def clean_best_version(spark, sf_dir):
    rows = records.process(records.best_version(corpus(spark, sf_dir)))
    return rows.select("page_id", "ord", "title", "collection_page_id", "first_ord")


@query(_with("SELECT count(*) AS read, count(*) - count(DISTINCT page_id) AS removed, count(DISTINCT page_id) AS written FROM corpus"))
def clean_counters(spark, sf_dir):
    return records.clean_counters(corpus(spark, sf_dir))


@query(_with("SELECT page_id, min(ord) AS ord FROM corpus GROUP BY page_id"))
def first_wins(spark, sf_dir):
    return records.first_wins(corpus(spark, sf_dir)).select("page_id", "ord")


@query(_with("SELECT page_id, max(ord) AS ord FROM corpus GROUP BY page_id"))
def last_wins(spark, sf_dir):
    return records.last_wins(corpus(spark, sf_dir)).select("page_id", "ord")


@query(_with("SELECT page_id, ord, collection_title FROM corpus WHERE collection_title IS NOT NULL AND collection_page_id IS NULL"))
def unidentified(spark, sf_dir):
    return records.unidentified(corpus(spark, sf_dir)).select("page_id", "ord", "collection_title")


@query(
    _with(
        "SELECT ord, page_id, title, author, publication_date, language, checksum_sha256, collection_page_id, collection_title, section_title, "
        "poem_order, hub_title, hub_page_id FROM corpus"
    )
)
def index_rows(spark, sf_dir):
    rows = corpus(spark, sf_dir).withColumn("extraction_timestamp", F.lit(None).cast("timestamp"))
    flat = records.index_rows(rows).drop("extraction_timestamp")
    return rows.select("ord", *[F.col(f"metadata.{c}") if c in ("author", "publication_date") else F.col(c) for c in flat.columns])


# -- scalar functions ------------------------------------------------------------------------------------

_ODD_TITLE = "case when doc_id % 10 = 0 then ' (a) ' when doc_id % 10 = 1 then concat(lang, '/') else concat(lang, '/ ', source, ' (v', doc_id % 3, ')  x  (y) ') end"


@query(f"WITH t AS (SELECT doc_id, {_ODD_TITLE} AS raw FROM documents) SELECT doc_id, {_TITLE_SQL.format('raw')} AS title FROM t")
def title_clean(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.clean_title(F.expr(_ODD_TITLE)).alias("title"))


_ODD_AUTHOR = (
    "case doc_id % 8 when 0 then concat('Auteur : ', source) when 1 then concat('(', source, ') - Non signé') "
    "when 2 then concat(source, ', auteur du texte ;Z', lang) when 3 then concat(source, 'Traduit par', lang) when 4 then concat('(', source, ')') "
    "when 5 then 'LAMARTINE' when 6 then concat('  ', source, '   x,Y ') else null end"
)


def _author_sql(raw: str) -> str:
    out = f"trim({raw})"
    for pattern, new, flags in (
        ("^[Aa]uteur\\s*:\\s*", "", "g"),
        ("\\s*-\\s*non signé", "", "gi"),
        ("\\s*,?\\s*auteur du texte", "", "gi"),
        ("Traduit par.*$", "", "gi"),
        ("([;,])([A-Z])", "\\1 \\2", "g"),
        ("^\\((.*?)\\)$", "\\1", ""),
        ("\\s+", " ", "g"),
    ):
        out = f"regexp_replace({out}, '{pattern}', '{new}', '{flags}')"
    out = f"trim({out})"
    cases = " ".join(f"WHEN '{k.lower()}' THEN '{v}'" for k, v in text.AUTHOR_NAMES.items())
    return f"CASE lower({out}) {cases} ELSE {out} END"


@query(f"WITH t AS (SELECT doc_id, {_ODD_AUTHOR} AS raw FROM documents) SELECT doc_id, {_author_sql('raw')} AS author FROM t")
def author_clean(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.clean_author(F.expr(_ODD_AUTHOR)).alias("author"))


@query(
    _with(
        "SELECT ord, coalesce(nullif(source_collection, ''), CASE WHEN contains(title, '/') AND length(trim(string_split(title, '/')[1])) < 70 "
        "THEN trim(string_split(title, '/')[1]) END) AS source_collection FROM corpus"
    )
)
def source_fallback(spark, sf_dir):
    found = text.source_fallback(F.col("metadata.source_collection"), F.col("title"))
    return corpus(spark, sf_dir).select("ord", found.alias("source_collection"))


@query("SELECT doc_id, sha256(text) AS checksum FROM documents")
def checksum(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.checksum(F.col("text")).alias("checksum"))


_BROKEN = "replace(text, '. ', '.\n\n  ')"
_STANZAS_SQL = (
    "list_filter(list_transform(string_split_regex(array_to_string(list_transform(string_split({0}, chr(10)), lambda l: trim(l)), chr(10)), '\\n\\n+'), "
    "lambda b: list_filter(string_split(b, chr(10)), lambda v: length(v) > 0)), lambda s: len(s) > 0)"
)


@query(
    f"WITH t AS (SELECT doc_id, {_STANZAS_SQL.format(_BROKEN)} AS s FROM documents) SELECT doc_id, len(s)::BIGINT AS stanzas, "
    "coalesce(list_sum(list_transform(s, lambda x: len(x))), 0)::BIGINT AS verses, s[1][1] AS first_verse FROM t"
)
def stanza_split(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", text.split_stanzas(F.expr(_BROKEN)).alias("s"))
    verses = F.aggregate("s", F.lit(0).cast("long"), lambda n, x: n + F.size(x))
    return rows.select("doc_id", F.size("s").cast("long").alias("stanzas"), verses.alias("verses"), F.try_element_at(F.try_element_at("s", F.lit(1)), F.lit(1)).alias("first_verse"))


@query(
    f"WITH t AS (SELECT doc_id, {_STANZAS_SQL.format(_BROKEN)} AS s FROM documents) SELECT doc_id, "
    "array_to_string(list_transform(s, lambda x: array_to_string(x, chr(10))), chr(10) || chr(10)) AS normalized_text FROM t"
)
def normalized_text(spark, sf_dir):
    s = text.split_stanzas(F.expr(_BROKEN))
    return table(spark, sf_dir, "documents").select("doc_id", text.joined_stanzas(s).alias("normalized_text"))


# -- enrichment and diff ---------------------------------------------------------------------------------

_KNOWN = (
    f"{_C}, known AS (SELECT collection_title, arg_min(collection_page_id, ord) AS known_id FROM corpus "
    "WHERE collection_title <> '' AND collection_page_id IS NOT NULL AND {0} GROUP BY collection_title)"
)
_LESS = "ord % 25 <> 4"


def _less(spark, sf_dir):
    """Some titles keep no known id at all."""
    return corpus(spark, sf_dir).withColumn("collection_page_id", F.expr(f"case when {_LESS} then collection_page_id end"))


@query(
    f"WITH {_KNOWN.format(_LESS)} SELECT ord, collection_title, coalesce(CASE WHEN {_LESS} THEN collection_page_id END, known_id) AS collection_page_id "
    "FROM corpus LEFT JOIN known USING (collection_title)"
)
def enrich_lookup(spark, sf_dir):
    return records.enrich(_less(spark, sf_dir)).select("ord", "collection_title", "collection_page_id")


@query(
    f"WITH {_KNOWN.format(_LESS)} SELECT DISTINCT collection_title FROM corpus ANTI JOIN known USING (collection_title) "
    f"WHERE collection_title <> '' AND (collection_page_id IS NULL OR NOT ({_LESS}))"
)
def enrich_missing(spark, sf_dir):
    return records.missing_titles(_less(spark, sf_dir))


@query(
    f"WITH {_KNOWN.format(_LESS)}, lacking AS (SELECT collection_title FROM corpus WHERE collection_title <> '' AND (collection_page_id IS NULL OR NOT ({_LESS}))) "
    "SELECT (SELECT count(*) FROM known) AS cached, (SELECT count(DISTINCT collection_title) FROM lacking ANTI JOIN known USING (collection_title)) AS to_fetch, "
    "(SELECT count(*) FROM lacking SEMI JOIN known USING (collection_title)) AS enriched"
)
def enrich_counters(spark, sf_dir):
    return records.enrich_counters(_less(spark, sf_dir))


_DIFF_COLUMNS = {
    "title": "nullif(title, '')",
    "metadata.author": "nullif(author, '')",
    "metadata.publication_date": "nullif(publication_date, '')",
    "collection_title": "nullif(collection_title, '')",
    "section_title": "nullif(section_title, '')",
    "poem_order": "nullif(poem_order, 0)::VARCHAR",
    "checksum_sha256": "checksum_sha256",
}
_SIDE = "SELECT page_id, {0} FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY ord DESC) AS n FROM corpus WHERE src = '{1}') WHERE n = 1"
_PICKED = ", ".join(f"{s} AS f{i}" for i, s in enumerate(_DIFF_COLUMNS.values()))
_DIFFER = " OR ".join(f"a.f{i} IS DISTINCT FROM b.f{i}" for i in range(len(_DIFF_COLUMNS)))
_DIFF = (
    f"{_C}, a AS ({_SIDE.format(_PICKED, 'A')}), b AS ({_SIDE.format(_PICKED, 'B')}), d AS (SELECT coalesce(a.page_id, b.page_id) AS page_id, "
    f"CASE WHEN a.page_id IS NULL THEN 'added' WHEN b.page_id IS NULL THEN 'removed' WHEN {_DIFFER} THEN 'modified' ELSE 'same' END AS status, "
    + ", ".join(f"a.f{i} AS a{i}, b.f{i} AS b{i}" for i in range(len(_DIFF_COLUMNS)))
    + " FROM a FULL JOIN b USING (page_id))"
)


@query(f"WITH {_DIFF} SELECT page_id, status FROM d")
def corpus_diff(spark, sf_dir):
    return records.diff(*sides(spark, sf_dir)).select("page_id", "status")


@query(
    f"WITH {_DIFF} "
    + " UNION ALL ".join(
        f"SELECT page_id, '{n}' AS field, a{i} AS before, b{i} AS after FROM d WHERE status = 'modified' AND a{i} IS DISTINCT FROM b{i}"
        for i, n in enumerate(_DIFF_COLUMNS)
    )
)
def corpus_diff_fields(spark, sf_dir):
    return records.diff(*sides(spark, sf_dir)).select("page_id", F.explode("changes").alias("c")).select("page_id", "c.*")


@query(
    f"WITH {_DIFF} SELECT count(*) FILTER (WHERE status = 'added') AS added, count(*) FILTER (WHERE status = 'removed') AS removed, "
    "count(*) FILTER (WHERE status = 'modified') AS modified, count(*) FILTER (WHERE status <> 'added') AS total_a, "
    "count(*) FILTER (WHERE status <> 'removed') AS total_b FROM d"
)
def diff_summary(spark, sf_dir):
    return records.diff_summary(records.diff(*sides(spark, sf_dir)))


_LINE = """
case when doc_id % 17 = 0 then '  ' when doc_id % 19 = 0 then '{bad' else concat('{"page_id":', doc_id, ',"revision_id":1,"title":', case when doc_id % 23 = 0 then '5' else '"t"' end,
',"language":"fr","wikisource_url":"', case when doc_id % 29 = 0 then 'nowhere' else 'https://fr.wikisource.org/wiki/t' end, '","hub_page_id":1,"metadata":{"author":null},
"structure":{"stanzas":[["a"]],"raw_markers":[]},"normalized_text":"a","raw_wikitext":"","checksum_sha256":"x","extraction_timestamp":"2024-01-01T00:00:00Z","provenance":"',
case when doc_id % 31 = 0 then 'other' else 'dump' end, '"}') end
""".replace("\n", " ").strip()


@query(
    "SELECT count(*) AS total, count(*) FILTER (WHERE doc_id % 17 <> 0 AND doc_id % 19 <> 0 AND doc_id % 23 <> 0 AND doc_id % 29 <> 0 AND doc_id % 31 <> 0) AS valid, "
    "count(*) FILTER (WHERE doc_id % 17 <> 0 AND (doc_id % 19 = 0 OR doc_id % 23 = 0 OR doc_id % 29 = 0 OR doc_id % 31 = 0)) AS errors FROM documents"
)
def validate_counts(spark, sf_dir):
    return records.validation_counts(table(spark, sf_dir, "documents").select(F.expr(_LINE).alias("value")))


# -- profile ---------------------------------------------------------------------------------------------

_ID = "coalesce(collection_page_id, 0) <> 0"
_UNKNOWN = f"NOT ({_ID}) AND collection_title <> ''"
_VERSES = "len(string_split(normalized_text, chr(10)))::BIGINT"


@query(
    _with(
        f"SELECT count(*) AS poems, count(DISTINCT nullif(author, '')) AS authors, count(DISTINCT CASE WHEN {_ID} THEN collection_page_id END) AS collections, "
        f"count(DISTINCT CASE WHEN {_UNKNOWN} THEN collection_title END) AS unidentified_titles FROM corpus"
    )
)
def profile_overview(spark, sf_dir):
    return profile.overview(corpus(spark, sf_dir))


_SHARES = {
    "with_author": "poems",
    "with_publication_date": "poems",
    "with_publisher": "poems",
    "with_translator": "poems",
    "with_order": "in_collection",
    "with_section": "identified",
    "sectioned_collections": "collections",
}


@query(
    f"WITH {_C}, n AS (SELECT count(*) AS poems, "
    + ", ".join(f"count(*) FILTER (WHERE {m} <> '') AS with_{m}" for m in ("author", "publication_date", "publisher", "translator"))
    + f", count(*) FILTER (WHERE {_ID}) AS identified, count(*) FILTER (WHERE {_UNKNOWN}) AS unidentified, count(poem_order) AS with_order, "
    f"count(*) FILTER (WHERE {_ID} AND section_title <> '') AS with_section, count(DISTINCT CASE WHEN {_ID} AND section_title <> '' THEN collection_page_id END) "
    f"AS sectioned_collections, count(DISTINCT CASE WHEN {_ID} THEN collection_page_id END) AS collections FROM corpus), "
    "m AS (SELECT *, identified + unidentified AS in_collection FROM n) SELECT *, "
    + ", ".join(f"round({p} * 100.0::DOUBLE / {w}, 2) AS {p}_pct" for p, w in _SHARES.items())
    + " FROM m"
)
def profile_completeness(spark, sf_dir):
    return profile.completeness(corpus(spark, sf_dir))


@query(
    f"WITH {_C}, v AS (SELECT 1::BIGINT AS s, {_VERSES} AS v FROM corpus) SELECT sum(s)::BIGINT AS stanzas, sum(v)::BIGINT AS verses, round(avg(s), 6) AS stanzas_avg, "
    "round(avg(v), 6) AS verses_avg, round_even(median(v), 0) AS verses_median, max(v) AS verses_max, min(v) AS verses_min FROM v"
)
def profile_structure(spark, sf_dir):
    return profile.structure(corpus(spark, sf_dir))


@query(
    f"WITH {_C}, same AS (SELECT count(*) AS n FROM corpus WHERE checksum_sha256 <> '' GROUP BY checksum_sha256), "
    f"t AS (SELECT count(DISTINCT collection_page_id) AS ids FROM corpus WHERE {_ID} AND collection_title <> '' GROUP BY collection_title HAVING ids > 1) "
    "SELECT (SELECT coalesce(sum(n - 1), 0)::BIGINT FROM same WHERE n > 1) AS exact_duplicates, (SELECT count(*) FROM t) AS shared_titles, "
    "(SELECT coalesce(sum(ids), 0)::BIGINT FROM t) AS collections_affected"
)
def profile_content(spark, sf_dir):
    return profile.content(corpus(spark, sf_dir))


_HUBS = (
    f"{_C}, hubs AS (SELECT hub_page_id, count(*) AS version_count, count(DISTINCT page_id) AS versions, "
    "arg_min(coalesce(nullif(hub_title, ''), 'Standalone poem: ' || title), ord) AS hub_label, min(ord) AS first_ord FROM corpus GROUP BY hub_page_id HAVING count(*) > 1)"
)


@query(f"WITH {_HUBS} SELECT count(*) AS real_hubs, coalesce(sum(versions), 0)::BIGINT AS poems_in_hubs FROM hubs")
def profile_versions(spark, sf_dir):
    return profile.versions(corpus(spark, sf_dir))


@query(f"WITH {_HUBS} SELECT hub_page_id, hub_label, version_count FROM hubs ORDER BY version_count DESC, first_ord LIMIT 10")
def top_hubs(spark, sf_dir):
    return profile.top_hubs(corpus(spark, sf_dir))


@query(_with("SELECT author, count(*) AS poem_count FROM corpus WHERE author <> '' GROUP BY author ORDER BY poem_count DESC, min(ord) LIMIT 10"))
def top_authors(spark, sf_dir):
    return profile.top_authors(corpus(spark, sf_dir))


_COLLECTIONS = (
    f"{_C}, books AS (SELECT collection_page_id, count(*) AS poem_count, count(DISTINCT nullif(collection_title, '')) AS title_count, "
    "count(DISTINCT nullif(section_title, '')) AS section_count, count(DISTINCT nullif(author, '')) AS author_count, "
    f"coalesce(min(nullif(collection_title, '')), 'ID: ' || collection_page_id) AS label, min(ord) AS first_ord FROM corpus WHERE {_ID} GROUP BY collection_page_id)"
)


@query(f"WITH {_COLLECTIONS} SELECT * FROM books")
def collection_profile(spark, sf_dir):
    return profile.collections(corpus(spark, sf_dir))


@query(
    _with(
        f"SELECT author, count(*) AS poem_count, count(DISTINCT CASE WHEN {_ID} THEN collection_page_id END) AS collection_count, min(ord) AS first_ord "
        "FROM corpus WHERE author <> '' GROUP BY author"
    )
)
def author_profile(spark, sf_dir):
    return profile.authors(corpus(spark, sf_dir))


@query(f"WITH {_COLLECTIONS} SELECT collection_page_id, label, poem_count FROM books ORDER BY poem_count DESC, first_ord LIMIT 10")
def top_collections(spark, sf_dir):
    return profile.top_collections(corpus(spark, sf_dir))


@query(f"WITH {_COLLECTIONS} SELECT collection_page_id, label, section_count FROM books ORDER BY section_count DESC, first_ord LIMIT 10")
def top_sections(spark, sf_dir):
    return profile.top_sections(corpus(spark, sf_dir))


@query(
    _with(
        f"SELECT collection_title, count(*) AS poem_count FROM corpus WHERE {_UNKNOWN} GROUP BY collection_title ORDER BY poem_count DESC, min(ord) LIMIT 10"
    )
)
def top_unidentified(spark, sf_dir):
    return profile.top_unidentified(corpus(spark, sf_dir))


@query(_with(f"SELECT page_id, title, ord, {_VERSES} AS verses FROM corpus ORDER BY verses DESC, ord LIMIT 10"))
def longest(spark, sf_dir):
    return profile.by_length(corpus(spark, sf_dir))


@query(_with(f"SELECT page_id, title, ord, {_VERSES} AS verses FROM corpus ORDER BY verses, ord LIMIT 10"))
def shortest(spark, sf_dir):
    return profile.by_length(corpus(spark, sf_dir), longest=False)


# -- views -----------------------------------------------------------------------------------------------

_NAMED = f"{_C}, named AS (SELECT *, coalesce(nullif(author, ''), '{views.NO_AUTHOR}') AS who, coalesce(nullif(source_collection, ''), '{views.NO_SOURCE}') AS panel FROM corpus)"
_BOOKS = f"{_NAMED}, books AS (SELECT collection_page_id, arg_min_null(collection_title, ord) AS title, arg_min(who, ord) AS author, count(*) AS poem_count FROM named WHERE {_ID} GROUP BY ALL)"


@query(f"WITH {_NAMED} SELECT count(DISTINCT who) AS authors, count(DISTINCT CASE WHEN {_ID} THEN collection_page_id END) AS collections, count(DISTINCT page_id) AS poems FROM named")
def home_counts(spark, sf_dir):
    return views.home_counts(corpus(spark, sf_dir))


@query(
    f"WITH {_NAMED} SELECT who AS author, count(DISTINCT CASE WHEN {_ID} THEN collection_page_id END) AS collection_count, "
    f"count(*) FILTER (WHERE NOT ({_ID})) AS orphan_count FROM named GROUP BY who"
)
def author_index(spark, sf_dir):
    return views.author_index(corpus(spark, sf_dir))


@query(f"WITH {_BOOKS} SELECT * FROM books")
def collection_index(spark, sf_dir):
    return views.collection_index(corpus(spark, sf_dir))


@query(
    f"WITH {_BOOKS}, linked AS (SELECT DISTINCT who, collection_page_id FROM named WHERE {_ID}), inside AS (SELECT who, sum(poem_count)::BIGINT AS n, count(*) AS c "
    f"FROM linked JOIN books USING (collection_page_id) GROUP BY who) SELECT w.who AS author, coalesce(c, 0)::BIGINT AS collection_count, (coalesce(n, 0) + orphans)::BIGINT AS poem_count "
    f"FROM (SELECT who, count(*) FILTER (WHERE NOT ({_ID})) AS orphans FROM named GROUP BY who) w LEFT JOIN inside i ON i.who = w.who"
)
def author_list_item(spark, sf_dir):
    return views.author_list(corpus(spark, sf_dir))


@query(
    f"WITH {_NAMED} SELECT ord, page_id, who AS author, title, title_count FROM (SELECT *, count(*) OVER (PARTITION BY who, title) AS title_count FROM named) WHERE title_count > 1"
)
def dup_titles_by_author(spark, sf_dir):
    rows = views.same_titles(corpus(spark, sf_dir))
    return rows.select("ord", "page_id", F.coalesce("metadata.author", F.lit(views.NO_AUTHOR)).alias("author"), "title", "title_count")


@query(f"WITH {_NAMED} SELECT who AS author, panel, count(*) AS poem_count, count(DISTINCT title) AS titles FROM named GROUP BY ALL")
def grouped_by_source_collection(spark, sf_dir):
    return views.grouped_by_source(corpus(spark, sf_dir))


@query(
    f"WITH {_NAMED}, twice AS (SELECT *, count(*) OVER (PARTITION BY who, title) AS n FROM named), "
    "p AS (SELECT who AS author, panel, page_id, ord, title FROM named UNION ALL "
    f"SELECT who, '{views.SEVERAL}', page_id, ord, title FROM twice WHERE n > 1) "
    f"SELECT *, CASE panel WHEN '{views.SEVERAL}' THEN 0 WHEN '{views.NO_SOURCE}' THEN 2 ELSE 1 END AS place FROM p"
)
def author_panels(spark, sf_dir):
    return views.panels(corpus(spark, sf_dir))


@query(_with("SELECT ord, page_id, title FROM corpus WHERE contains(lower(title), 'fr/')"))
def search_sort_list(spark, sf_dir):
    return views.search(corpus(spark, sf_dir).select("ord", "page_id", "title"), "title", "FR/")


@query(f"WITH {_BOOKS} SELECT books.* FROM books SEMI JOIN (SELECT collection_page_id FROM named WHERE {_ID} AND who = '{views.NO_AUTHOR}') o USING (collection_page_id)")
def author_detail(spark, sf_dir):
    return views.author_detail(corpus(spark, sf_dir), views.NO_AUTHOR)


@query(
    _with(
        "SELECT page_id, title, section_title, coalesce(poem_order, 0) AS poem_order, ord, section_title IS NOT NULL AND (row_number() OVER w = 1 OR "
        "section_title IS DISTINCT FROM lag(section_title) OVER w) AS header FROM corpus WHERE collection_page_id = 5 WINDOW w AS (ORDER BY coalesce(poem_order, 0), ord)"
    )
)
def collection_detail(spark, sf_dir):
    return views.collection_detail(corpus(spark, sf_dir), 5)


@query(_with("SELECT ord, page_id, title FROM corpus WHERE page_id = 7"))
def poem_lookup(spark, sf_dir):
    return views.poem(corpus(spark, sf_dir), 7).select("ord", "page_id", "title")


# -- ordered collections ---------------------------------------------------------------------------------


def _items(spark, sf_dir):
    kind = F.when(F.col("role") == "user", "SECTION_TITLE").otherwise("POEM")
    return table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("collection_id"), F.col("turn").alias("pos"), F.col("text").alias("title"), kind.alias("kind"))


_CARRIED = (
    "carried AS (SELECT *, last_value(CASE WHEN role = 'user' THEN text END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS section FROM conversations), poems AS (SELECT * FROM carried WHERE role <> 'user')"
)
_NUMBERED = f"{_CARRIED}, numbered AS (SELECT *, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1)::INT AS n FROM poems WHERE turn % 5 <> 3)"


def _numbered(spark, sf_dir):
    # every item reaches the operator, which leaves out the unresolved ones
    items = _items(spark, sf_dir).withColumn("resolved", F.expr("pos % 5 != 3"))
    return context.numbered(context.carry_sections(items))


@query(f"WITH {_CARRIED} SELECT conv_id AS collection_id, turn AS pos, text AS title, section AS section_title FROM poems")
def section_carry_forward(spark, sf_dir):
    return context.carry_sections(_items(spark, sf_dir)).drop("kind")


@query(f"WITH {_NUMBERED} SELECT conv_id AS collection_id, turn AS pos, n AS poem_order FROM numbered")
def poem_order(spark, sf_dir):
    return _numbered(spark, sf_dir).select("collection_id", "pos", "poem_order")


@query(f"WITH {_NUMBERED} SELECT conv_id AS collection_id, turn AS pos FROM numbered WHERE n = 0")
def first_in_collection(spark, sf_dir):
    return _numbered(spark, sf_dir).where("is_first_poem").select("collection_id", "pos")


@query(
    f"WITH {_NUMBERED} SELECT conv_id AS collection_id, n AS poem_order, n = 0 OR section IS DISTINCT FROM lag(section) OVER (PARTITION BY conv_id ORDER BY n) AS header FROM numbered"
)
def header_break(spark, sf_dir):
    return context.header_breaks(_numbered(spark, sf_dir)).select("collection_id", "poem_order", "header")


@query(
    "SELECT conv_id AS collection_id, turn AS pos, text AS title FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, text ORDER BY turn) AS n FROM conversations) WHERE n = 1"
)
def items_by_title(spark, sf_dir):
    return context.first_by_title(_items(spark, sf_dir)).drop("kind")


# -- joins -----------------------------------------------------------------------------------------------


def _pages(spark, sf_dir):
    doc = table(spark, sf_dir, "documents")
    return doc.select(F.col("doc_id").alias("page_id"), F.expr("doc_id % 2 * 14").cast("int").alias("namespace"), F.expr("concat('T_', doc_id div 3)").alias("title"))


_PAGES = "pg AS (SELECT doc_id AS page_id, (doc_id % 2 * 14)::INT AS namespace, concat('T_', doc_id // 3) AS title FROM documents)"
_IDS = f"{_PAGES}, ids AS (SELECT replace(title, '_', ' ') AS title, max(page_id) AS page_id FROM pg WHERE namespace = 0 GROUP BY ALL)"


@query(f"WITH {_IDS} SELECT * FROM ids")
def title_to_id(spark, sf_dir):
    return context.title_ids(_pages(spark, sf_dir))


@query(f"WITH {_IDS}, asked AS (SELECT doc_id, concat('T ', doc_id // 2) AS title FROM documents) SELECT doc_id, a.title, ids.page_id FROM asked a LEFT JOIN ids ON ids.title = a.title")
def resolve_titles(spark, sf_dir):
    asked = table(spark, sf_dir, "documents").select("doc_id", F.expr("concat('T_', doc_id div 2)").alias("_t"))
    found = context.resolve(asked.withColumnRenamed("_t", "title"), context.title_ids(_pages(spark, sf_dir)))
    return found.select("doc_id", text.spaced(F.col("title")).alias("title"), "page_id")


@query("SELECT d.doc_id AS page_id, quality, CASE WHEN d.doc_id % 2 = 0 THEN d.text ELSE '' END AS wikitext FROM documents d LEFT JOIN labels USING (doc_id)")
def context_join(spark, sf_dir):
    doc, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    wiki = doc.where("doc_id % 2 = 0").select(F.col("doc_id").alias("page_id"), F.col("text").alias("wikitext"))
    return context.attach(doc.select(F.col("doc_id").alias("page_id")), labels.select(F.col("doc_id").alias("page_id"), "quality"), wiki)


@query("SELECT doc_id AS page_id FROM documents ANTI JOIN labels USING (doc_id)")
def anti_resume(spark, sf_dir):
    ids = lambda n: table(spark, sf_dir, n).select(F.col("doc_id").alias("page_id"))
    return context.without(ids("documents"), ids("labels"))


@query("SELECT page_id FROM (SELECT doc_id + 5 AS page_id FROM documents UNION SELECT doc_id FROM documents) EXCEPT SELECT doc_id FROM labels")
def discover_minus_known(spark, sf_dir):
    doc = table(spark, sf_dir, "documents")
    found = doc.select((F.col("doc_id") + 5).alias("page_id")).unionByName(doc.select(F.col("doc_id").alias("page_id")))
    return context.without(found, table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id")))


@query(
    _with(
        "SELECT c.ord, c.title, p.parent_id FROM corpus c LEFT JOIN (SELECT lang AS title, min(doc_id) AS parent_id FROM documents WHERE lang IS NOT NULL GROUP BY lang) p "
        "ON string_split(c.title, '/')[1] = p.title"
    )
)
def parent_inference(spark, sf_dir):
    books = table(spark, sf_dir, "documents").where("lang is not null").groupBy(F.col("lang").alias("title")).agg(F.min("doc_id").alias("page_id"))
    return context.infer_parent(corpus(spark, sf_dir).select("ord", "title"), books)


# -- graphs ----------------------------------------------------------------------------------------------


def _geo(spark, sf_dir):
    r, n, c = (table(spark, sf_dir, x) for x in ("region", "nation", "customer"))
    nation = n.select(F.concat(F.lit("r"), "n_regionkey").alias("parent"), F.concat(F.lit("n"), "n_nationkey").alias("child"))
    customer = c.select(F.concat(F.lit("n"), "c_nationkey").alias("parent"), F.concat(F.lit("c"), "c_custkey").alias("child"))
    nodes = [r.select(F.concat(F.lit("r"), "r_regionkey").alias("node"), F.lit("REGION").alias("type"))]
    nodes += [nation.select(F.col("child").alias("node"), F.lit("NATION").alias("type"))]
    nodes += [c.select(F.concat(F.lit("c"), "c_custkey").alias("node"), F.col("c_mktsegment").alias("type"))]
    return records.union_all(nodes), nation.unionByName(customer)


_GEO = (
    "nodes AS (SELECT concat('r', r_regionkey) AS node, 'REGION' AS type FROM region UNION ALL SELECT concat('n', n_nationkey), 'NATION' FROM nation "
    "UNION ALL SELECT concat('c', c_custkey), c_mktsegment FROM customer), "
    "edges AS (SELECT concat('r', n_regionkey) AS parent, concat('n', n_nationkey) AS child FROM nation UNION ALL "
    "SELECT concat('n', c_nationkey), concat('c', c_custkey) FROM customer)"
)


@query(f"WITH {_GEO} SELECT parent, count(*) AS members FROM edges GROUP BY parent")
def category_members(spark, sf_dir):
    return _geo(spark, sf_dir)[1].groupBy("parent").agg(F.count(F.lit(1)).alias("members"))


def _doc_edges(spark, sf_dir):
    doc = table(spark, sf_dir, "documents")
    tree = doc.where("doc_id >= 2").select(F.expr("doc_id div 2").alias("parent"), F.col("doc_id").alias("child"))
    circle = doc.where("doc_id = 5").select(F.col("doc_id").alias("parent"), F.lit(2).cast("long").alias("child"))
    return tree.unionByName(circle)


_DOC_EDGES = "edges AS (SELECT doc_id // 2 AS parent, doc_id AS child FROM documents WHERE doc_id >= 2 UNION ALL SELECT 5, 2)"
_REACHED = f"{_DOC_EDGES}, reached AS (SELECT 2::BIGINT AS node UNION SELECT child FROM edges JOIN reached ON parent = node)"


@query(f"WITH RECURSIVE {_REACHED} SELECT node FROM reached")
def category_closure(spark, sf_dir):
    return graph.reachable(_doc_edges(spark, sf_dir), spark.range(2, 3).withColumnRenamed("id", "node"))


def _wiki(spark, sf_dir):
    """Category pages (namespace 14) are even ids; category n lists category 2n and 2n+2, and odd pages below it."""
    doc = table(spark, sf_dir, "documents").select("doc_id")
    even, odd = doc.where("doc_id % 2 = 0"), doc.where("doc_id % 2 = 1")
    pages = doc.select(F.col("doc_id").alias("page_id"), F.expr("case when doc_id % 2 = 0 then 14 else 0 end").alias("namespace"), F.expr("concat('C ', doc_id)").alias("title"))
    targets = even.select((F.col("doc_id") + 1000000).alias("target_id"), F.lit(14).alias("namespace"), F.expr("concat('C_', doc_id)").alias("title"))
    sub = even.where("doc_id > 2").select(F.col("doc_id").alias("page_id"), F.expr("1000000 + doc_id div 4 * 2").alias("target_id"), F.lit("subcat").alias("type"))
    page = odd.select(F.col("doc_id").alias("page_id"), F.expr("1000000 + doc_id div 6 * 2").alias("target_id"), F.lit("page").alias("type"))
    return pages, sub.unionByName(page), targets


_WIKI = (
    "sub AS (SELECT doc_id AS child, doc_id // 4 * 2 AS parent FROM documents WHERE doc_id % 2 = 0 AND doc_id > 2), "
    "leaf AS (SELECT doc_id AS page_id, doc_id // 6 * 2 AS parent FROM documents WHERE doc_id % 2 = 1)"
)


@query(
    f"WITH RECURSIVE {_WIKI}, reached AS (SELECT 4::BIGINT AS node UNION SELECT child FROM sub JOIN reached ON parent = node) "
    "SELECT DISTINCT page_id FROM leaf JOIN reached ON parent = node"
)
def closure_pages(spark, sf_dir):
    return graph.pages_in_category(*_wiki(spark, sf_dir), "C 4")


@query(f"WITH {_WIKI} SELECT page_id, 0 AS namespace, concat('C ', page_id) AS title FROM leaf WHERE parent = 4")
def category_direct(spark, sf_dir):
    return graph.direct_members(*_wiki(spark, sf_dir), "C_4").select("page_id", "namespace", "title")


@query(
    f"WITH {_WIKI}, m AS (SELECT parent, 1 AS p, 0 AS s FROM leaf UNION ALL SELECT parent, 0, 1 FROM sub) "
    "SELECT concat('C ', parent) AS title, sum(p)::BIGINT AS pages, sum(s)::BIGINT AS subcats FROM m WHERE parent IN (SELECT doc_id FROM documents) GROUP BY parent"
)
def category_sizes(spark, sf_dir):
    _, rows, targets = _wiki(spark, sf_dir)
    return graph.category_sizes(rows, targets)


@query(
    f"WITH {_WIKI}, t AS (SELECT doc_id FROM documents WHERE doc_id % 2 = 0) SELECT d.doc_id AS page_id, coalesce(list('C ' || t.doc_id) FILTER (WHERE t.doc_id IS NOT NULL), []) AS categories "
    "FROM documents d LEFT JOIN (SELECT child AS page_id, parent FROM sub UNION ALL SELECT * FROM leaf) m ON m.page_id = d.doc_id LEFT JOIN t ON t.doc_id = m.parent GROUP BY d.doc_id"
)
def page_categories(spark, sf_dir):
    pages, rows, targets = _wiki(spark, sf_dir)
    return context.with_categories(pages.select("page_id"), rows.select("page_id", "target_id"), targets)


_REDIRECTS = "r AS (SELECT doc_id AS source, doc_id - 1 AS target FROM documents WHERE doc_id % 10 BETWEEN 1 AND 6 UNION ALL SELECT 1000001, 1000002 UNION ALL SELECT 1000002, 1000001)"


@query(
    f"WITH {_REDIRECTS} SELECT a.source, CASE WHEN e.source IS NULL THEN coalesce(d.target, c.target, b.target, a.target) END AS resolved FROM r a LEFT JOIN r b ON b.source = a.target "
    "LEFT JOIN r c ON c.source = b.target LEFT JOIN r d ON d.source = c.target LEFT JOIN r e ON e.source = d.target"
)
def redirect_resolve(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").where("doc_id % 10 between 1 and 6").select(F.col("doc_id").alias("source"), (F.col("doc_id") - 1).alias("target"))
    return graph.resolve_redirects(rows.unionByName(spark.createDataFrame([(1000001, 1000002), (1000002, 1000001)], rows.schema)))


@query(
    f"WITH RECURSIVE {_GEO}, up AS (SELECT parent AS a, child AS d FROM edges UNION ALL SELECT e.parent, d FROM edges e JOIN up ON e.child = a) "
    "SELECT node, direct_children, total_descendants FROM (SELECT parent AS node, count(*) AS direct_children FROM edges GROUP BY parent) "
    "JOIN (SELECT a AS node, count(*) AS total_descendants FROM up GROUP BY a) USING (node)"
)
def tree_descendants(spark, sf_dir):
    return graph.descendant_counts(_geo(spark, sf_dir)[1])


@query(
    f"WITH RECURSIVE {_GEO}, up AS (SELECT node FROM nodes WHERE type = 'BUILDING' UNION SELECT parent FROM edges JOIN up ON child = node) SELECT nodes.* FROM nodes SEMI JOIN up USING (node)"
)
def tree_filter_ancestors(spark, sf_dir):
    return graph.matching_with_ancestors(*_geo(spark, sf_dir), ["BUILDING"])


def _other_geo(spark, sf_dir):
    nodes, edges = _geo(spark, sf_dir)
    nodes = nodes.where("node not like 'n%9'").withColumn("type", F.when(F.col("node") == "n3", "STATE").otherwise(F.col("type")))
    nodes = nodes.unionByName(spark.createDataFrame([("r9", "REGION")], "node string, type string"))
    return nodes, edges.where("child not like 'n%9' and parent not like 'n%9'").withColumn("parent", F.when(F.col("child") == "n7", "r0").otherwise(F.col("parent")))


@query(
    f"WITH {_GEO}, nodes2 AS (SELECT node, CASE WHEN node = 'n3' THEN 'STATE' ELSE type END AS type FROM nodes WHERE node NOT LIKE 'n%9' UNION ALL SELECT 'r9', 'REGION'), "
    "edges2 AS (SELECT CASE WHEN child = 'n7' THEN 'r0' ELSE parent END AS parent, child FROM edges WHERE child NOT LIKE 'n%9' AND parent NOT LIKE 'n%9'), "
    "gone AS (SELECT parent AS node, list(child ORDER BY child) AS gone FROM (SELECT * FROM edges EXCEPT SELECT * FROM edges2) GROUP BY parent), "
    "come AS (SELECT parent AS node, list(child ORDER BY child) AS come FROM (SELECT * FROM edges2 EXCEPT SELECT * FROM edges) GROUP BY parent), "
    "f AS (SELECT coalesce(a.node, b.node) AS node, a.node AS na, b.node AS nb, a.type AS type_a, b.type AS type_b FROM nodes a FULL JOIN nodes2 b ON a.node = b.node) "
    "SELECT node, CASE WHEN na IS NULL THEN 'added' WHEN nb IS NULL THEN 'removed' ELSE 'modified' END AS status, type_a, type_b, "
    "CASE WHEN na IS NOT NULL AND nb IS NOT NULL THEN array_to_string(coalesce(come, []), ',') END AS children_added, "
    "CASE WHEN na IS NOT NULL AND nb IS NOT NULL THEN array_to_string(coalesce(gone, []), ',') END AS children_removed "
    "FROM f LEFT JOIN gone USING (node) LEFT JOIN come USING (node) "
    "WHERE na IS NULL OR nb IS NULL OR type_a IS DISTINCT FROM type_b OR come IS NOT NULL OR gone IS NOT NULL"
)
def tree_diff(spark, sf_dir):
    found = graph.compare_trees(graph.flatten(*_geo(spark, sf_dir)), graph.flatten(*_other_geo(spark, sf_dir)))
    for c in ("children_added", "children_removed"):
        found = found.withColumn(c, F.array_join(c, ","))
    return found


@query(f"WITH {_GEO} SELECT type, count(*) AS nodes FROM nodes GROUP BY type")
def type_counts(spark, sf_dir):
    return _geo(spark, sf_dir)[0].groupBy("type").agg(F.count(F.lit(1)).alias("nodes"))


@query(f"WITH {_GEO} SELECT DISTINCT type FROM nodes")
def type_facet(spark, sf_dir):
    return _geo(spark, sf_dir)[0].select("type").distinct()


# -- pages -----------------------------------------------------------------------------------------------

_LINKS = "hrefs AS (SELECT page_id, unnest(h) AS href, (unnest(range(len(h))))::INT AS pos FROM (SELECT page_id, regexp_extract_all(html, '<a[^>]*href=\"([^\"]*)\"', 1) AS h FROM pages))"
_TITLED = (
    f"{_LINKS}, titled AS (SELECT *, replace(url_decode(string_split(CASE WHEN starts_with(href, '/wiki/') THEN substr(href, 7) "
    "WHEN starts_with(href, './') THEN substr(href, 3) ELSE '' END, '#')[1]), '_', ' ') AS link_title FROM hrefs)"
)


@query(f"WITH {_LINKS} SELECT page_id, pos, href FROM hrefs")
def page_links(spark, sf_dir):
    return links.hrefs(table(spark, sf_dir, "pages"))


def _wiki_pages(spark, sf_dir):
    """Some links are made internal, so that titles come out of them."""
    page = table(spark, sf_dir, "pages")
    return page.withColumn("html", F.replace("html", F.lit('href="/'), F.lit('href="/wiki/P_%C3%A9/')))


@query(_TITLED.replace("regexp_extract_all(html,", "regexp_extract_all(replace(html, 'href=\"/', 'href=\"/wiki/P_%C3%A9/'),").join(("WITH ", " SELECT page_id, pos, href, link_title FROM titled")))
def link_titles(spark, sf_dir):
    return links.titled(_wiki_pages(spark, sf_dir))


@query(
    _TITLED.replace("regexp_extract_all(html,", "regexp_extract_all(replace(html, 'href=\"/', 'href=\"/wiki/P_%C3%A9/'),").join(
        ("WITH ", " SELECT page_id, link_title, min(pos) AS pos FROM titled GROUP BY page_id, link_title")
    )
)
def adjacent_dedup(spark, sf_dir):
    return links.first_by_title(links.titled(_wiki_pages(spark, sf_dir)))


# -- events ----------------------------------------------------------------------------------------------


@query(
    "WITH i AS (SELECT user_id AS page_id, event_id AS ord, event_type = 'purchase' AS has_context FROM events), s AS (SELECT *, row_number() OVER w AS n, "
    "coalesce(max(has_context::INT) OVER (PARTITION BY page_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS had FROM i WINDOW w AS (PARTITION BY page_id ORDER BY ord)) "
    "SELECT page_id, ord, has_context FROM s WHERE n = 1 OR (has_context AND had = 0)"
)
def schedule_dedup(spark, sf_dir):
    items = table(spark, sf_dir, "events").select(F.col("user_id").alias("page_id"), F.col("event_id").alias("ord"), (F.col("event_type") == "purchase").alias("has_context"))
    return schedule.schedule_batch(items)


def _said(c: str):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("start")


@query(
    "SELECT event_id, user_id, count(*) OVER (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN 3600000000 PRECEDING AND CURRENT ROW) AS in_window FROM events"
)
def rate_window(spark, sf_dir):
    return schedule.rate(table(spark, sf_dir, "events"), "user_id", 3600).select("event_id", "user_id", "in_window")


@query("SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S.%f') AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def ext_tumbling(spark, sf_dir):
    return schedule.tumbling(table(spark, sf_dir, "events")).select(_said("window.start"), "event_type", "n")


@query(
    "WITH g AS (SELECT *, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER w < 1800000000 THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), "
    "s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS session FROM g) SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS start, count(*) AS n FROM s GROUP BY user_id, session"
)
def ext_session(spark, sf_dir):
    return schedule.sessions(table(spark, sf_dir, "events")).select("user_id", _said("session_window.start"), "n")


from . import file_queries, wiki_queries  # noqa: E402, F401 - they register their queries here
