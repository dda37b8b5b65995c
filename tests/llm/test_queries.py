"""SQL of the subpackage's queries, their registration, and edge cases common to all operators."""

import oracle
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from stanzaflow.llm import ann, exact, langid, mixing, pii, piece, quality, queries, simhash, suffix, urlfilter

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
@pytest.mark.parametrize("at", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_sql(spark, name, at):
    names, more, less = oracle.differences(queries.queries()[name](spark, at), oracle.connect(at), queries.oracle_sql()[name])
    assert not more and not less, (names, more, less)


def test_all_are_registered():
    found = entry.queries()
    for n in range(1, 11):
        assert sum(q.startswith(f"op{n}_") for q in found) == 1
    assert "pipeline" in found and len(corpus_pipeline.STAGES) == 5


def odd_documents(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, clashing extra columns."""
    long = "The quick brown fox jumps over the lazy dog. " * 4000
    rows = [
        (1, "same words in two places of this small table, more than fifty bytes of them", "en", "a", 3),
        (2, "same words in two places of this small table, more than fifty bytes of them", None, "b", None),
        (2, "same words in two places of this small table, more than fifty bytes of them", None, "b", None),
        (3, None, None, None, None),
        (4, "", "en", None, 0),
        (None, "a text without id", "en", "a", 1),
        (5, " \t\n ", None, "a", 1),
        (6, long, "en", "a", len(long)),
        (7, long + "x", "en", "b", len(long) + 1),
        (8, "1234 5678 !!", None, "b", 2),
        (9, "é\u0000\U0001f600\u200b ﬁ", "fr", "a", 4),
    ]
    docs = spark.createDataFrame(rows, DOCS)
    for extra in ("fp", "text2", "key", "size", "mark", "spans", "held_out", "score", "range", "taken", "_digest", "quality", "component_id", "_id", "_doc", "_text", "_best", "fps", "root", "label", "_salt"):
        docs = docs.selectExpr("*", f"doc_id as `{extra}`")
    return docs


RUNS = {
    "simhash": simhash.near_groups,
    "suffix": suffix.dedup,
    "langid": langid.predict,
    "piece": piece.digests,
    "pii": pii.spans,
    "mixing": mixing.mix_plan,
    "exact": exact.exact_groups,
}


@pytest.mark.parametrize("name", sorted(RUNS))
def test_odd_rows(spark, name):
    docs = odd_documents(spark)
    got = RUNS[name](docs).collect()
    assert len(got) == docs.count()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r["doc_id"]) for r in docs.collect())
    # repeated rows get equal values
    assert len({tuple(r) for r in got if r["doc_id"] == 2}) == 1


@pytest.mark.parametrize("name", sorted(RUNS))
def test_empty_table(spark, name):
    assert RUNS[name](spark.createDataFrame([], DOCS)).collect() == []


def test_odd_labels(spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (6, 0, None), (None, 1, 1), (99, 1, 0), (4, None, 0), (9, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality.score(odd_documents(spark), labels).collect()
    assert len(got) == 11 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    none = quality.score(odd_documents(spark), labels.where("false")).collect()
    assert {r["score"] for r in none} == {0.5}
    assert quality.score(spark.createDataFrame([], DOCS), labels).collect() == []


def test_odd_pages(spark):
    pages = spark.createDataFrame([(1, None), (2, "no scheme"), (3, ""), (None, "http://A.ORG/x"), (4, "http://x.com"), (4, "http://x.com")], "page_id long, url string")
    got = urlfilter.judge(pages.selectExpr("*", "url as host", "url as rule")).collect()
    assert len(got) == 6 and {r["verdict"] for r in got} <= {"allow", "block"}
    assert urlfilter.judge(pages.where("false")).collect() == []


def test_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (20, [1.0, 0.0]), (20, [1.0, 0.0]), (40, None), (60, []), (80, [0.0, 0.0]), (100, [1.0, None]), (120, [float("nan"), 1.0]), (3, [2.0, 1.0]), (None, [1.0, 1.0]), (5, [1.0, 0.0, 0.0])]
    twice = [(0, [0.0, 1.0]), (0, [1.0, 0.0]), (1, [1.0, 0.5])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "vec_id as rank", "vec_id as vec")
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in ann.nearest(vectors).collect())
    assert got == [(0, 1, 3, 2.0), (0, 2, 20, 1.0), (20, 1, 3, 2.0), (20, 2, 0, 1.0)]
    assert ann.nearest(vectors.where("false")).collect() == []
    got = sorted(tuple(r) for r in ann.nearest(spark.createDataFrame(twice, "vec_id long, embedding array<float>")).collect())
    assert got == [(0, 1, 1, 0.5), (0, 1, 1, 1.0)]


@pytest.mark.parametrize("keep", [exact.exact_dedup, simhash.near_dedup, langid.keep_known, mixing.mix_documents])
def test_stages_keep_columns(spark, keep):
    docs = odd_documents(spark)
    assert keep(docs).columns == docs.columns
    keep(docs).collect()
    assert keep(spark.createDataFrame([], DOCS)).collect() == []
