"""Order-dependent record operators against a sequential fold."""

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stanzaflow import schema
from stanzaflow.operators import records

_SCHEMA = (
    "page_id long, ord long, title string, language string, collection_page_id long, collection_title string, section_title string, hub_page_id long, "
    "metadata struct<author:string,publication_date:string,source_collection:string,publisher:string,translator:string>, normalized_text string"
)
_ROW = st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.one_of(st.none(), st.integers(0, 2)), st.one_of(st.none(), st.just("s")), st.sampled_from(["", "x" * 250]))


def frame(spark, rows):
    made = [(p, i, f"t{i}", "fr", c, "T", s, p, (None, " ", None, "x", None), x) for i, (p, c, s, x) in enumerate(rows)]
    return spark.createDataFrame(made, _SCHEMA)


def score(row):
    _, c, s, x = row
    return (50 if c is not None else 0) + (20 if s is not None else 0) + 10 + len(x) // 100


def fold(a, b, strategy):
    held, dup, b_wins = {}, 0, 0
    for i, r in enumerate(a):
        if r[0] is not None:
            held[r[0]] = ("A", i, r)
    for i, r in enumerate(b):
        if r[0] is None:
            continue
        if r[0] not in held:
            held[r[0]] = ("B", i, r)
            continue
        dup += 1
        if strategy == "keep_b" or (strategy == "keep_richest" and score(r) > score(held[r[0]][2])):
            held[r[0]] = ("B", i, r)
            b_wins += 1
    return [(p, s, i) for p, (s, i, _) in held.items()], dup, b_wins


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(a=st.lists(_ROW, max_size=12), b=st.lists(_ROW, max_size=12), strategy=st.sampled_from(records.STRATEGIES))
def test_merge(spark, a, b, strategy):
    fa, fb = frame(spark, a), frame(spark, b)
    got = records.merge(fa, fb, strategy).orderBy("first_src", "first_ord").select("page_id", "src", "ord").collect()
    want, dup, b_wins = fold(a, b, strategy)
    assert [tuple(r) for r in got] == want
    n = records.merge_counters(fa, fb, strategy).first()
    assert (n["duplicates"], n["b_wins"], n["a_wins"]) == (dup, b_wins, dup - b_wins)
    assert n["total_a"] == sum(r[0] is not None for r in a)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(_ROW, max_size=15))
def test_best_version(spark, rows):
    best = {}
    for i, r in enumerate(rows):
        if r[0] is not None and (r[0] not in best or (best[r[0]][1][1] is None and r[1] is not None)):
            best[r[0]] = (i, r)
    got = records.best_version(frame(spark, rows)).orderBy("first_ord").select("page_id", "ord").collect()
    assert {r["page_id"]: r["ord"] for r in got} == {p: i for p, (i, _) in best.items()}
    assert [r["page_id"] for r in got] == list(best)
    n = records.clean_counters(frame(spark, rows)).first()
    assert (n["read"], n["written"], n["removed"]) == (len(rows), len(best), len(rows) - len(best))


def test_clashing_columns(spark):
    rows = frame(spark, [(1, None, None, ""), (1, 2, "s", "")])
    assert records.process(records.last_wins(rows.withColumn("text", rows["title"]))).count() == 1


GOOD = {
    "page_id": 1, "revision_id": 0, "title": "t", "language": "fr", "wikisource_url": "https://fr.wikisource.org/wiki/t", "hub_page_id": 1, "metadata": {},
    "structure": {"stanzas": [["a"]], "raw_markers": []}, "normalized_text": "a", "raw_wikitext": "", "checksum_sha256": "0",
}


@pytest.mark.parametrize(
    ("change", "state"),
    [
        ({}, "valid"),
        ({"page_id": "12"}, "valid"),
        ({"page_id": "x"}, "invalid"),
        ({"page_id": None}, "invalid"),
        ({"title": 5}, "invalid"),
        ({"wikisource_url": "t"}, "invalid"),
        ({"provenance": "web"}, "invalid"),
        ({"structure": {"stanzas": ["a"], "raw_markers": []}}, "invalid"),
        ({"metadata": {"author": 3}}, "invalid"),
        ({"metadata": None}, "invalid"),
        ({"poem_order": 1.5}, "invalid"),
        ({"poem_order": 0}, "valid"),
    ],
)
def test_validation(spark, change, state):
    line = json.dumps(GOOD | change)
    assert records.judged(spark.createDataFrame([(line,)], "value string")).first()["state"] == state


def test_validation_counts(spark):
    lines = [json.dumps(GOOD), "", "  ", "{bad", json.dumps(GOOD | {"title": None})]
    assert tuple(records.validation_counts(spark.createDataFrame([(x,) for x in lines], "value string")).first()) == (5, 1, 2)
    assert schema.RECORD.startswith("page_id bigint")
