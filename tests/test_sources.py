"""Readers, writers, ingest and command line on small hand-made files."""

import gzip
import json

import pytest

from stanzaflow import cli
from stanzaflow.plans import ingest
from stanzaflow.sources import corpus, dumps
from stanzaflow.streaming import schedule


def record(i, **more):
    return {"page_id": i, "title": f"B{i}/T{i} (x)", "language": "fr", "metadata": {"author": "A"}, "normalized_text": "a"} | more


def test_jsonl(spark, tmp_path):
    for name, ids in (("b.jsonl.gz", [3, 1]), ("a.jsonl.gz", [2, 1])):
        with gzip.open(tmp_path / name, "wt") as f:
            f.write("\n".join([json.dumps(record(i)) for i in ids] + ["", "{bad", json.dumps(record(9, title="x\ry"))]))
    rows = corpus.read_jsonl(spark, str(tmp_path))
    assert [r["page_id"] for r in rows.orderBy("ord").collect()] == [2, 1, 9, 3, 1, 9]
    assert corpus.read_broken(spark, str(tmp_path)).count() == 2
    with pytest.raises(Exception, match="MALFORMED"):
        corpus.read_jsonl(spark, str(tmp_path), strict=True).collect()
    corpus.write_jsonl(rows, str(tmp_path / "out"))
    assert corpus.processed_ids(spark, str(tmp_path / "out")).count() == 4
    line = spark.read.text(str(tmp_path / "out")).first()[0]
    assert "hub_title" not in line and "\\r" in "".join(r[0] for r in spark.read.text(str(tmp_path / "out")).collect())
    assert corpus.newest(spark, str(tmp_path / "*.gz")).endswith(".jsonl.gz")
    with pytest.raises(FileNotFoundError, match="nothing"):
        corpus.require(spark, [str(tmp_path / "a*"), str(tmp_path / "nothing*")])
    assert corpus.free_bytes(spark, str(tmp_path)) > 0


def test_sql_tuples():
    line = r"INSERT INTO `t` VALUES (1,'a\'b\\c\n\0\z',NULL,-2.5e3,'(x),y'),(2,'',null,3,'é');"
    assert list(dumps.sql_tuples(line)) == [["1", "a'b\\c\n\0z", None, "-2.5e3", "(x),y"], ["2", "", None, "3", "é"]]
    assert list(dumps.sql_tuples("INSERT INTO `t` VALUES (1,'open")) == []
    assert list(dumps.sql_tuples("no tuples")) == []


def test_read_sql(spark, tmp_path):
    path = tmp_path / "page.sql"
    path.write_text("-- x\nINSERT INTO `page` VALUES (1,0,'A_b',0,0,0.5,'t','t',7,80,'w',NULL),(1,0,'later',0,0,0,'','',0,1,'',''),('x',0,'bad',0,0,0,'','',0,1,'','');\n")
    assert [tuple(r) for r in dumps.read_sql(spark, str(path), "page").collect()] == [(1, 0, "A b", 0, 80)]


def test_ndjson_and_xml(spark, tmp_path):
    lines = [
        {"identifier": 1, "name": "A", "url": "u", "version": {"identifier": 5}, "article_body": {"html": "<p>"}, "date_modified": "d"},
        {"identifier": 2, "article_body": None},
        {"name": "no id"},
    ]
    (tmp_path / "a.ndjson").write_text("\n".join(map(json.dumps, lines)) + "\n{bad\n")
    got = dumps.read_ndjson(spark, str(tmp_path / "*.ndjson")).orderBy("page_id")
    assert [tuple(r) for r in got.collect()] == [(1, 5, "A", "u", "<p>", "d"), (2, 0, "", "", "", "")]
    assert dumps.read_ndjson(spark, str(tmp_path / "*.ndjson"), spark.range(2, 3).withColumnRenamed("id", "page_id")).count() == 1
    page = "<page><title>{t}</title><ns>{n}</ns><id>{i}</id><revision><id>7</id><text bytes='3' xml:space='preserve'>{x}</text></revision></page>"
    body = page.format(t="A", n=0, i=1, x=" a\n") + page.format(t="B", n=4, i=2, x="b") + page.format(t="C", n=0, i=3, x="")
    (tmp_path / "x.xml").write_text(f'<mediawiki xmlns="http://www.mediawiki.org/xml/export-0.11/">{body}</mediawiki>')
    got = dumps.read_xml(spark, str(tmp_path / "*.xml")).orderBy("page_id")
    assert [tuple(r) for r in got.collect()] == [(1, 7, "A", " a\n"), (3, 7, "C", "")]


def test_trees(spark, tmp_path):
    (tmp_path / "t.json").write_text(json.dumps({"name": "r", "children": [{"name": "a", "type": "POEM", "reason": "x", "timestamp": "1", "children": [{"name": "b"}]}, {"name": "c"}]}))
    rows = corpus.read_tree(spark, str(tmp_path / "t.json"))
    assert {(r["node"], r["parent"], r["type"]) for r in rows.collect()} == {("r", None, None), ("a", "r", "POEM"), ("b", "a", None), ("c", "r", None)}
    drawn = corpus.tree_text([r.asDict() for r in rows.where("parent is not null").orderBy("node").collect()], "r")
    assert drawn.splitlines()[1:] == [
        "Direct sub-pages explored: 2",
        "Total descendants found: 3",
        "",
        "├── 1 - a [POEM (x)]",
        "│   └──  - b [ ()]",
        "└──  - c [ ()]",
    ]


def test_tree_files(spark, tmp_path):
    columns = "author string, node string, parent string, type string, reason string, timestamp string"
    rows = [("Catégorie:A b", "x", "Catégorie:A b", "POEM", "r", "2"), ("Catégorie:A b", "y", "x", "POEM", "r", "3"), ("Catégorie:A b", "w", "Catégorie:A b", "OTHER", "q", "1"), ("B", "x", "B", None, None, "1")]
    nodes = spark.createDataFrame(rows, columns)
    files = {r["name"]: r for r in corpus.tree_files(nodes).collect()}
    assert sorted(files) == ["a_b", "b"]
    tree = json.loads(files["a_b"]["json"])
    assert (tree["direct_children"], tree["total_descendants"]) == (2, 3) and [c["name"] for c in tree["children"]] == ["w", "x"]
    assert tree["children"][1]["children"] == [{"name": "y", "type": "POEM", "reason": "r", "timestamp": "3"}]
    assert files["a_b"]["text"].splitlines()[4:] == ["├── 1 - w [OTHER (q)]", "└── 2 - x [POEM (r)]", "    └── 3 - y [POEM (r)]"]
    corpus.write_trees(nodes, str(tmp_path / "trees"))
    (tmp_path / "again.json").write_text(files["a_b"]["json"])
    again = corpus.read_tree(spark, str(tmp_path / "again.json")).where("parent is not null")
    assert {tuple(r) for r in again.select("node", "parent").collect()} == {(r[1], r[2]) for r in rows[:3]}
    assert spark.read.text(str(tmp_path / "trees" / "txt")).where("name = 'a_b'").count() == 7


def test_losses_are_named(spark, tmp_path):
    (tmp_path / "a.ndjson").write_text('{"identifier": 1}\n{bad\n{"name": "x"}\n\n')
    got = dumps.broken_ndjson(spark, str(tmp_path / "a.ndjson")).collect()
    assert sorted((r["line"], r["reason"]) for r in got) == [('{"name": "x"}', "no id"), ("{bad", "broken")]
    (tmp_path / "a.xml").write_text("<mediawiki><page><id>1</id></page>\n</mediawiki>\n")
    (tmp_path / "d.xml").write_text("<page><id>1</id></page>\n<page><id>2</id></page>\n</mediawiki>")
    (tmp_path / "b.xml").write_text("<mediawiki><page>")
    (tmp_path / "c.xml.gz").write_bytes(gzip.compress(b"<mediawiki>" + bytes(range(256)) * 999 + b"</mediawiki>")[:150])
    got = {r["file"].rsplit("/", 1)[1]: (r["pages"], r["read"]) for r in dumps.broken_xml(spark, str(tmp_path / "*.xml*")).collect()}
    assert got == {"b.xml": (1, 0), "c.xml.gz": (0, 0), "d.xml": (2, 1)}


def test_find_page(spark):
    pages = spark.createDataFrame([(1, 0, "Ab c"), (2, 0, "Ab"), (3, 0, "Aa"), (4, 4, "A")], "page_id long, namespace int, title string")
    assert [dumps.find_page(pages, t).first()["page_id"] for t in ("Ab", "Ab ", "A")] == [2, 1, 3]
    assert dumps.find_page(pages, "z").count() == 0


def test_snapshot(spark):
    """Page data over redirects: text and categories of the page a redirect leads to; null where it leads nowhere."""
    pages = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C")], "page_id long, title string")
    html, xml = spark.createDataFrame([(1, "<p>")], "page_id long, html string"), spark.createDataFrame([(1, "w")], "page_id long, wikitext string")
    links, targets = spark.createDataFrame([(1, 9)], "page_id long, target_id long"), spark.createDataFrame([(9, 14, "K_l")], "target_id long, namespace int, title string")
    moved = spark.createDataFrame([(2, 1), (3, None)], "source long, resolved long")
    got = {r["page_id"]: (r["title"], r["resolved_id"], r["html"], r["wikitext"], r["categories"]) for r in dumps.snapshot(pages, html, xml, links, targets, moved).collect()}
    assert got == {1: ("A", 1, "<p>", "w", ["K l"]), 2: ("B", 1, "<p>", "w", ["K l"]), 3: ("C", None, None, None, [])}
    plain = {r["page_id"]: r["html"] for r in dumps.snapshot(pages, html, xml, links, targets).collect()}
    assert plain == {1: "<p>", 2: None, 3: None}


@pytest.fixture
def wiki(tmp_path):
    page = lambda i, ns, t: f"({i},{ns},'{t}',0,0,0,'','',0,9,'',NULL)"
    rows = [(1, 0, "Book"), (2, 0, "Song_A"), (3, 0, "Song_B"), (4, 0, "Hub"), (5, 0, "Lone"), (6, 0, "Old_name"), (7, 0, "Named"), (8, 0, "Odd"), (10, 14, "Poems"), (11, 14, "Sub")]
    (tmp_path / "page.sql").write_text("INSERT INTO `page` VALUES " + ",".join(page(*r) for r in rows) + ";\n")
    links = [(1, "page", 100), (11, "subcat", 100), (5, "page", 101), (4, "page", 101), (8, "page", 101)]
    (tmp_path / "cl.sql").write_text("INSERT INTO `c` VALUES " + ",".join(f"({a},'','','','{k}',0,{t})" for a, k, t in links) + ";\n")
    (tmp_path / "lt.sql").write_text("INSERT INTO `l` VALUES (100,14,'Poems'),(101,14,'Sub');\n")
    (tmp_path / "rd.sql").write_text("INSERT INTO `r` VALUES (6,0,'Song_B',NULL,NULL);\n")
    html = {
        1: '<div class="mw-parser-output"><div id="toc"></div><ul><li><a href="/wiki/Song_A">a</a></li><li><b>Part</b></li><li><a href="/wiki/Old_name">b</a></li></ul></div>',
        2: "<poem>one\ntwo</poem>",
        3: '<poem>three</poem><span itemprop="author">Auteur : X</span>',
        4: '<ul><li><a href="/wiki/Lone">Lone Hub</a></li><li><a href="/wiki/Hub_(2)">x</a></li></ul><a title="d:Q1">w</a>',
        5: '<poem>lone</poem><span itemprop="isPartOf">Named</span>',
        7: '<div id="toc"></div>',
        8: "<p>no verse</p>",
    }
    titles = {i: t.replace("_", " ") for i, _, t in rows}
    lines = [{"identifier": i, "name": titles[i], "article_body": {"html": h}, "version": {"identifier": i + 50}} for i, h in html.items()]
    (tmp_path / "h.ndjson").write_text("\n".join([*map(json.dumps, lines), "{broken"]))
    xml = "".join(f"<page><title>{titles[i]}</title><ns>0</ns><id>{i}</id><revision><id>1</id><text>{{{{titre|auteur=W{i}}}}}</text></revision></page>" for i in (2, 3))
    (tmp_path / "x.xml").write_text(f"<mediawiki>{xml}</mediawiki>")
    return tmp_path


def test_ingest(spark, wiki):
    d = ingest.Dumps(*[str(wiki / f) for f in ("page.sql", "cl.sql", "lt.sql", "h.ndjson", "x.xml", "rd.sql")])
    result = ingest.ingest(spark, d, "Poems", "fr", str(wiki / "work"))
    rows = [r.asDict(True) for r in result.records.collect()]
    assert [r["page_id"] for r in rows] == [2, 3, 5]
    a, b, lone = rows
    assert (a["collection_page_id"], a["collection_title"], a["section_title"], a["poem_order"]) == (1, "Book", None, 0)
    assert (b["section_title"], b["poem_order"], b["metadata"]["author"]) == ("Part", 1, "X")
    assert a["metadata"]["author"] == "W2" and lone["metadata"]["author"] is None
    content = a["collection_structure"]["content"]
    assert [(c["title"], c["page_id"]) for c in content] == [("Song A", 2), ("Part", None)] and content[1]["poems"][0]["page_id"] == 3
    assert b["collection_structure"] is None and lone["collection_page_id"] is None and lone["hub_page_id"] == 5
    assert a["structure"] == {"stanzas": [["one", "two"]], "raw_markers": ["<poem>"]} and a["normalized_text"] == "one\ntwo"
    assert a["wikisource_url"] == "https://fr.wikisource.org/wiki/Song_A" and lone["raw_wikitext"] == ""
    # the collection that a poem names is looked at too
    assert {(r["PageTitle"], r["Reason"], r["ChildCount"]) for r in result.collections.collect()} == {("Book", "toc", 2), ("Named", "toc", 0)}
    assert [(r["PageTitle"], r["ParentTitle"]) for r in result.other.collect()] == [("Odd", "")]
    assert [(r["PageTitle"], r["ChildCount"]) for r in result.hubs.collect()] == [("Hub", 0)]
    assert {(r["node"], r["parent"]) for r in result.tree.collect()} >= {("Song B", "Book"), ("Book", "Poems")}
    # without redirects the moved title is not found
    plain = ingest.Dumps(d.page, d.categorylinks, d.linktarget, d.html, d.xml)
    assert [r["page_id"] for r in ingest.ingest(spark, plain, "Poems", "fr", str(wiki / "work2")).records.collect()] == [2, 5]


def test_ingest_command(spark, wiki, capsys):
    files = {"page": "page.sql", "categorylinks": "cl.sql", "linktarget": "lt.sql", "redirect": "rd.sql", "html": "h.ndjson", "xml": "x.xml"}
    where = [x for k, f in files.items() for x in (f"--{k}", str(wiki / f))]
    line = ["ingest", *where, "--category", "Poems", "--output", str(wiki / "out"), "--work", str(wiki / "work"), "--tree-log"]
    assert cli.main([*line, "--limit", "1"]) == 0
    assert cli.main([*line, "--resume"]) == 0
    assert "broken lines 1, broken files 0" in capsys.readouterr().out
    got = corpus.read_jsonl(spark, str(wiki / "out"))
    assert sorted(r["page_id"] for r in got.collect()) == [2, 3, 5]
    assert corpus.read_jsonl(spark, str(wiki / "out.cleaned")).count() == 3
    assert schedule.read_index(spark, str(wiki / "out.index")).count() == 3
    logs = spark.read.option("header", True).csv(str(wiki / "out.logs" / "other_pages"))
    assert logs.columns == ["Timestamp", "PageTitle", "URL", "ParentTitle", "Reason"] and [r["PageTitle"] for r in logs.collect()] == ["Odd"]
    assert spark.read.text(str(wiki / "out.trees" / "txt")).where("value like '%Hub%'").count() == 1
    assert cli.main([*line[:1], *where[:2], *where[2:], "--category", "x", "--output", "o", "--work", "/proc/no/such"]) == 1
    assert cli.main(["validate", str(wiki / "nothing")]) == 1


def test_command_line(spark, tmp_path, capsys):
    for name, ids in (("a", [1, 2, 2]), ("b", [2, 3])):
        (tmp_path / f"{name}.jsonl").write_text("\n".join(json.dumps(record(i, collection_page_id=None, collection_title="C")) for i in ids))
    a, b = str(tmp_path / "a.jsonl"), str(tmp_path / "b.jsonl")
    assert cli.main(["merge", "--file-a", a, "--file-b", b, "-o", str(tmp_path / "m")]) == 0
    assert cli.main(["clean", "-i", str(tmp_path / "m"), "-o", str(tmp_path / "c")]) == 0
    got = corpus.read_jsonl(spark, str(tmp_path / "c"))
    assert sorted((r["page_id"], r["title"]) for r in got.collect()) == [(1, "T1"), (2, "T2"), (3, "T3")]
    for command in ("enrich", "unidentified"):
        assert cli.main([command, "-i", a, "-o", str(tmp_path / command)]) == 0
    assert corpus.read_jsonl(spark, str(tmp_path / "unidentified")).count() == 3
    assert cli.main(["diff", "--file-a", a, "--file-b", b, "-o", str(tmp_path / "d")]) == 0
    assert cli.main(["analyze", a]) == 0
    for view in cli.VIEWS:
        assert cli.main(["explore", a, "--view", view, "--query", "A"]) == 0
    for name, below in (("s", ["x", "y"]), ("t", ["y", "z"])):
        (tmp_path / f"{name}.json").write_text(json.dumps({"name": "r", "children": [{"name": x, "type": "POEM"} for x in below]}))
    assert cli.main(["tree-diff", "--file-a", str(tmp_path / "s.json"), "--file-b", str(tmp_path / "t.json"), "-o", str(tmp_path / "td")]) == 0
    assert {(r["node"], r["status"]) for r in spark.read.json(str(tmp_path / "td")).collect()} == {("r", "modified"), ("x", "removed"), ("z", "added")}
    (tmp_path / "pg.sql").write_text("INSERT INTO `page` VALUES (77,0,'C',0,0,0,'','',0,9,'',NULL);\n")
    assert cli.main(["enrich", "-i", a, "-o", str(tmp_path / "e2"), "--page", str(tmp_path / "pg.sql")]) == 0
    assert {r["collection_page_id"] for r in corpus.read_jsonl(spark, str(tmp_path / "e2")).collect()} == {77}
    assert cli.main(["validate", a]) == 1
    assert "errors 3" in capsys.readouterr().out
