"""Every query of the library against its SQL; those without SQL for shape."""

import oracle
import pytest

from stanzaflow.operators import context
from stanzaflow.plans import catalogue


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_sql(spark, sf_dir, con, name):
    names, more, less = oracle.differences(catalogue.QUERIES[name](spark, sf_dir), con, catalogue.SQL[name])
    assert not more and not less, (names, more, less)


def test_every_query_has_sql():
    assert set(catalogue.QUERIES) == set(catalogue.SQL)


def test_unresolved_poems_get_no_order(spark):
    items = [(1, 0, "s", "SECTION_TITLE", True), (1, 1, "a", "POEM", False), (1, 2, "b", "POEM", True), (1, 3, "c", "POEM", None), (1, 4, "d", "POEM", True)]
    poems = context.carry_sections(spark.createDataFrame(items, "collection_id long, pos long, title string, kind string, resolved boolean"))
    got = context.header_breaks(context.numbered(poems)).orderBy("pos")
    assert [(r["title"], r["poem_order"], r["is_first_poem"], r["header"]) for r in got.collect()] == [("b", 0, True, True), ("d", 1, False, False)]
    every = context.numbered(poems.drop("resolved")).orderBy("pos").collect()
    assert [r["poem_order"] for r in every] == [0, 1, 2, 3]
