"""Text, link and page functions on their edge cases."""

import pytest
from pyspark.sql import functions as F

from stanzaflow.functions import links, markup, text
from stanzaflow.operators import context, graph


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v")).alias("o")).first()["o"]


AUTHORS = [
    ("Auteur : André Theuriet", "André Theuriet"),
    ("Auteur:Philippe Desportes", "Philippe Desportes"),
    ("(Alphonse de Lamartine) -non signé", "Alphonse de Lamartine"),
    ("Victor Hugo - NON SIGNÉ", "Victor Hugo"),
    ("Théodore Hannon, auteur du texte", "Théodore Hannon"),
    ("Théodore Hannon, auteur du texte ;Joris Karl Huysmans", "Théodore Hannon ; Joris Karl Huysmans"),
    ("Henrik IbsenTraduit parA. Matthey", "Henrik Ibsen"),
    ("lamartine", "Alphonse de Lamartine"),
    ("Nikolaus Becker,Alphonse de Lamartine", "Nikolaus Becker, Alphonse de Lamartine"),
    ("(Alphonse de Lamartine)", "Alphonse de Lamartine"),
    ("\xa0 A  B\xa0", "A B"),
    ("  ", ""),
    (None, None),
]


@pytest.mark.parametrize(("raw", "want"), AUTHORS)
def test_clean_author(spark, raw, want):
    assert one(spark, raw, text.clean_author) == want


@pytest.mark.parametrize(
    ("raw", "want"),
    [("Book/Part/Song (v2)  x", "Song x"), ("(all)", "(all)"), (" a /", "a /"), ("a\xa0\xa0b", "a b"), ("", ""), (None, None)],
)
def test_clean_title(spark, raw, want):
    assert one(spark, raw, text.clean_title) == want


def test_stanzas(spark):
    raw = "a\xa0\n  b \n\n\n \nc\n"
    assert one(spark, raw, text.split_stanzas) == [["a", "b"], ["c"]]
    assert one(spark, raw, lambda c: text.joined_stanzas(text.split_stanzas(c))) == "a\nb\n\nc"
    assert one(spark, " \n ", text.split_stanzas) == []


@pytest.mark.parametrize(
    ("href", "want"),
    [("/wiki/A_b%20c#x", "A b c"), ("./L%27%C3%A9t%C3%A9", "L'été"), ("/wiki/1+1", "1+1"), ("/wiki/100%", "100%"), ("https://x", ""), ("", "")],
)
def test_href_title(spark, href, want):
    assert one(spark, href, links.href_title) == want


def test_urls(spark):
    assert one(spark, "L'été à/b (c)", text.url_path) == "L%27%C3%A9t%C3%A9_%C3%A0/b_%28c%29"
    assert one(spark, 'A b:"c"', text.file_name) == "a_b__c_"


def parse(html, **kw):
    return markup.parse(html, "Own", **kw)


PAGE = '<div class="mw-parser-output">{}</div>'


def stanzas(spark, html):
    rows = spark.createDataFrame([(html, "Own")], "html string, title string").withColumn("p", markup.parse_page(F.col("html"), F.col("title")))
    return rows.select(markup.stanzas(F.col("p")).alias("s"), "p.raw_markers").first()


def test_verse_structure(spark):
    assert tuple(stanzas(spark, "<poem>\na\nb\n\nc\n</poem>")) == ([["a", "b"], ["c"]], ["<poem>"])
    assert stanzas(spark, '<poem class="x">\n:a\n::b</poem>')[0] == [[":a", "::b"]]
    assert stanzas(spark, "<poem>a</poem><p>no</p><poem>b</poem>")[0] == [["a"], ["b"]]
    assert stanzas(spark, "<poem> \n </poem>")[0] == []
    assert stanzas(spark, "plain")[0] == []
    html = '<div class="poem"><p>a<br>b<span class="pagenum">9</span></p><p>c</p></div><poem>not this</poem>'
    assert tuple(stanzas(spark, html)) == ([["a", "b"], ["c"]], ['<div class="poem">'])


def typed(spark, html, namespace=0, title="T", categories=()):
    rows = spark.createDataFrame([(1, title, namespace, list(categories), html)], "page_id long, title string, namespace int, categories array<string>, html string")
    return tuple(markup.classify(rows).select("type", "reason").first())


DATA = '<a title="d:Q1" href="x">w</a>'


def test_page_types(spark):
    cases = [
        (("", 102, "Auteur:X"), ("AUTHOR", "is_author_page")),
        (("", 4), ("OTHER", "is_other_namespace")),
        (("", 0, "T", ["Catégorie:Recueils de poèmes"]), ("POETIC_COLLECTION", "is_recueil_cat")),
        (("", 0, "T", ["Éditions multiples"]), ("MULTI_VERSION_HUB", "is_multiversion_cat")),
        ((f'<div class="ws-summary"></div>{DATA}',), ("MULTI_VERSION_HUB", "has_donnees_structurees and ws_summary")),
        (('<div id="toc"></div>',), ("POETIC_COLLECTION", "toc")),
        (("<h2><span>Éditions</span></h2>",), ("POETIC_COLLECTION", "editions_header")),
        (("<h2>Éditions <i>a</i></h2>",), ("OTHER", "no_signals_matched")),
        (("<poem>a</poem>",), ("POEM", "has_poem_structure")),
        ((f"<ul><li>a</ul>{DATA}",), ("MULTI_VERSION_HUB", "has_donnees_structurees and has_list_items")),
    ]
    for args, want in cases:
        assert typed(spark, *args) == want


def test_items():
    html = (
        "<h2>First</h2><ul><li><a href='/wiki/A'>a</a><li><a href='/wiki/B' title='B2'>b</a><li><b>Second</b></ul>"
        "<p><a href='/wiki/A'>again</a></p><dl><dt>no</dt><dd><a href='./C_c'>c</a></dd></dl>"
        "<p><a href='/wiki/R&amp;redlink=1'>r</a></p><p><a href='/wiki/Own'>self</a></p><p><a href='/wiki/Aide:X'>h</a></p>"
        "<p><a href='/wiki/I'><img src=x></a></p>"
    )
    got = [(i["title"], i["kind"]) for i in parse(PAGE.format(html))["items"]]
    assert got[:5] == [("First", "SECTION_TITLE"), ("A", "POEM"), ("B2", "POEM"), ("Second", "SECTION_TITLE"), ("C c", "POEM")]
    assert ("R", "POEM") not in got and ("Own", "POEM") not in got
    assert parse(html)["items"] == []


def test_hub_titles():
    html = "<a href='/wiki/Own_(1850)'>x</a><a href='/wiki/Own/2'>y</a><a href='/wiki/Other'>z</a><a href='/wiki/My_own_song'>w</a>"
    assert parse(html)["sub_titles"] == ["Own (1850)", "Own/2", "My own song"]


def test_itemprops():
    html = (
        "<span itemprop=author> V. H. </span><span itemprop=author>no</span><meta itemprop=datePublished content=' 1850 '>"
        "<div itemprop=isPartOf><a href=x>t <span itemprop=name>Book</span></a> rest</div>"
    )
    got = parse(html)
    assert (got["author"], got["publication_date"], got["source_collection"], got["publisher"]) == ("V. H.", "1850", "Book", None)


def test_wikitext():
    code = "{{Auteur|}}{{auteur|B}}{{Infoédit|AUTEUR=par [[Auteur:X Y|X]]|ANNÉE='''1850'''|RECUEIL=[[A|B]] {{t|x}}}}{{titre|recueil=no}}"
    assert markup.wikitext_metadata(code) == {"author": "", "publication_date": "1850", "source_collection": "B"}
    assert markup.wikitext_metadata("{{titre|auteur={{a|b=c}}|recueil=R}}") == {"author": "{{a|b=c}}", "source_collection": "R"}
    assert markup.wikitext_metadata(None) == {}


def test_tree_repair():
    root = markup.tree("<p>a<p>b<ul><li>c<li>d</ul><script>'</p>'</script><b>e")
    names = [n.name for n in root.walk()]
    assert names == ["p", "p", "ul", "li", "li", "script", "b"]


def test_templates_in_linear_time():
    deep = "{{titre|auteur=" * 4000 + "x" + "}}" * 4000
    assert len(markup.templates(deep)) == 4000
    assert markup.templates("{{a|[[b|c]]|{{d|e}}|x=[[y|z]]|{{t}}=1}}") == [("a", {"1": "[[b|c]]", "2": "{{d|e}}", "x": "[[y|z]]", "3": "{{t}}=1"}), ("d", {"1": "e"}), ("t", {})]
    assert markup._stripped("a{{b{{c}}d}}e" + "{{" * 5000 + "}}" * 5000) == "ae"
    assert markup._stripped("{{{x}}} {{a{b}} }} {{c") == "{} {{a{b}} }} {{c"


def test_one_bad_page_is_contained(spark, monkeypatch):
    pages = spark.createDataFrame([(1, "A", 0, [], "<poem>x</poem>"), (2, "B", 0, [], None)], "page_id long, title string, namespace int, categories array<string>, html string")
    assert [r["type"] for r in markup.classify(pages).orderBy("page_id").collect()] == ["POEM", "OTHER"]
    assert markup._contained("<p>", 5)["error"].startswith("AttributeError") or markup._contained("<p>", 5)["error"]
    broken = markup.classify(pages).withColumn("parsed", F.col("parsed").withField("error", F.when(F.col("page_id") == 2, F.lit("ValueError: x"))))
    typed = broken.withColumn("_t", markup.page_type(F.col("parsed"), F.col("namespace"), F.col("title"), F.col("categories"))).select("page_id", "title", "parsed", "_t.type")
    assert [r["type"] for r in typed.orderBy("page_id").collect()] == ["POEM", None]
    empty = typed.withColumn("parsed", F.when(F.col("page_id") == 1, F.col("parsed").withField("block_texts", F.array(F.lit(" ")))).otherwise(F.col("parsed")))
    assert sorted((r["page_id"], r["reject"], r["detail"]) for r in markup.rejects(empty).collect()) == [(1, markup.NO_STANZAS, "no stanza"), (2, markup.UNREADABLE, "ValueError: x")]


def test_closures_end_on_cycles(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("x", "y"), ("y", "z"), ("x", "w")], "parent string, child string")
    pairs = {tuple(r) for r in graph.ancestry(edges).collect()}
    assert {(a, b) for a in "abc" for b in "abcd"} <= pairs and ("x", "z") in pairs and len(pairs) == 16
    got = {r["node"]: (r["direct_children"], r["total_descendants"]) for r in graph.descendant_counts(edges).collect()}
    assert got == {"a": (1, None), "b": (1, None), "c": (2, None), "x": (2, 3), "y": (1, 1)}
    chain = spark.range(1, 40).selectExpr("id as parent", "id + 1 as child")
    assert {r["node"]: r["total_descendants"] for r in graph.descendant_counts(chain).collect()} == {i: 40 - i for i in range(1, 40)}
    assert graph.reachable(chain, spark.createDataFrame([(10,)], "node long")).count() == 31


def test_parents_with_one_title(spark):
    poems = spark.createDataFrame([(1, "B/x"), (2, "C")], "page_id long, title string")
    books = spark.createDataFrame([(10, "B"), (11, "B")], "page_id long, title string")
    assert sorted(tuple(r) for r in context.infer_parent(poems, books).select("page_id", "parent_id").collect()) == [(1, 11), (2, None)]


def test_siblings(spark):
    rows = [("é", "r", "2", 1), ("f", "r", None, 3), ("e", "r", "1", None), ("r", None, "0", 3)]
    nodes = spark.createDataFrame(rows, "node string, parent string, timestamp string, child_count int")
    order = lambda *how: [r["node"] for r in graph.sorted_siblings(nodes, *how).where("parent = 'r'").orderBy("place").collect()]
    assert order("name") == ["e", "é", "f"] and order("name", True) == ["f", "é", "e"]
    assert order("timestamp") == ["e", "é", "f"] and order("timestamp", True) == ["é", "e", "f"]
    assert order("child_count") == ["é", "f", "e"] and order("child_count", True) == ["f", "é", "e"]


def test_poem_in_two_collections(spark):
    """The collection with the largest id takes the poem; the other one keeps it in its structure, and its first place."""
    items = spark.createDataFrame([(1, 0, "A", "POEM"), (1, 1, "B", "POEM"), (9, 0, "S", "SECTION_TITLE"), (9, 1, "A", "POEM")], "collection_id long, pos long, title string, kind string")
    ids = spark.createDataFrame([("A", 100), ("B", 200)], "title string, page_id long")
    got = {r["page_id"]: tuple(r)[1:] for r in context.build(items, ids, spark.createDataFrame([(100,), (200,)], "page_id long")).collect()}
    assert got == {100: (9, "S", 0, True), 200: (1, None, 1, False)}
    whole = {r["collection_id"]: [[p["page_id"] for p in e["poems"]] for e in r["content"]] for r in context.structures(items, ids).collect()}
    assert whole == {1: [[100, 200]], 9: [[100]]}
