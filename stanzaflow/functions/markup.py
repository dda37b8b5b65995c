"""Page functions that need a document tree: signals, verse structure, links, metadata; wikitext templates.

One pandas UDF reads a page once and returns all of it; what follows from it is
plain column work. The tree is built with the standard library's tokenizer.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import links as lk
from . import text as t

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset(("script", "style"))
#: An opening tag closes these open ones.
_CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
} | {x: {"p"} for x in "p div ul ol dl table h1 h2 h3 h4 h5 h6 section article blockquote pre form hr poem".split()}
_SCOPE = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}}
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))


class Node:
    __slots__ = ("attrs", "children", "name", "parent", "start")

    def __init__(self, name: str, attrs: dict, start: str, parent: Node | None):
        self.name, self.attrs, self.start, self.parent, self.children = name, attrs, start, parent, []

    def walk(self):
        """Elements below, in document order, without recursion."""
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            node = stack.pop()
            yield node
            stack += [c for c in reversed(node.children) if isinstance(c, Node)]

    def classes(self) -> list[str]:
        return (self.attrs.get("class") or "").split()

    def strings(self):
        stack = list(reversed(self.children))
        while stack:
            c = stack.pop()
            if isinstance(c, Node):
                stack += reversed(c.children)
            else:
                yield c

    def text(self) -> str:
        """Stripped strings, joined."""
        return "".join(s.strip() for s in self.strings())

    def only_string(self) -> str | None:
        node = self
        while len(node.children) == 1:
            if isinstance(node.children[0], str):
                return node.children[0]
            node = node.children[0]
        return None


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, "", None)

    def handle_starttag(self, tag, attrs):
        closes, scope = _CLOSES.get(tag, ()), _SCOPE.get(tag, frozenset(("td", "th", "li", "dd", "div", "article", "table")))
        node = self.at
        while node.parent is not None and node.name not in scope:
            if node.name in closes:
                self.at = node.parent
                break
            node = node.parent
        node = Node(tag, {k: v if v is not None else "" for k, v in attrs}, self.get_starttag_text() or f"<{tag}>", self.at)
        self.at.children.append(node)
        if tag not in _VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        node = self.at
        while node.parent is not None and node.name != tag:
            node = node.parent
        if node.parent is not None:
            self.at = node.parent

    def handle_data(self, data):
        self.at.children.append(data)


def tree(html: str | None) -> Node:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


# -- verse ----------------------------------------------------------------------------------------------


def _marker(node: Node) -> str:
    attrs = "".join(f' {k}="{v}"' for k, v in node.attrs.items())
    return f"<{node.name}{attrs}>"


def _verse_text(block: Node) -> str:
    out: list[str] = []

    def closing(name: str) -> str:
        return "\n\n" if name == "p" else "\n" if name == "div" else ""

    stack: list = list(reversed(block.children))
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            out.append(x)
        elif isinstance(x, tuple):
            out.append(x[0])
        elif x.name == "br":
            out.append("\n")
        elif x.name in _RAW or (x.name == "span" and "pagenum" in x.classes()):
            continue
        else:
            stack.append((closing(x.name),))
            stack += reversed(x.children)
    return "".join(out)


def verse_blocks(root: Node, block: str = "poem") -> tuple[list[str], list[str]]:
    """Texts and markers of the verse blocks: div or span of that class, else elements of that name."""
    found = [n for n in root.walk() if n.name in ("div", "span") and block in n.classes()]
    found = found or [n for n in root.walk() if n.name == block]
    return [_verse_text(n) for n in found], [_marker(n) for n in found]


# -- links and lists ------------------------------------------------------------------------------------


class _Page:
    def __init__(self, root: Node, title: str, lang: str):
        self.root, self.title, self.ignored = root, title, tuple(f"{p}:" for p in lk.ignored_prefixes(lang))

    def href_title(self, href: str) -> str:
        for start in ("/wiki/", "./"):
            if href.startswith(start):
                return unquote(href[len(start) :].split("#")[0]).replace("_", " ")
        return ""

    def leads_to_text(self, a: Node) -> bool:
        href = a.attrs.get("href", "")
        if a.name != "a" or not href.startswith(("/wiki/", "./")) or "&redlink=1" in href or "action=edit" in href:
            return False
        named = self.href_title(href)
        title = a.attrs.get("title", named)
        if not title or title.startswith(self.ignored) or self.title in (title, named):
            return False
        return all(n.name != "img" for n in a.walk())

    def first_link(self, node: Node) -> Node | None:
        return next((n for n in node.walk() if self.leads_to_text(n)), None)

    def is_section(self, node: Node) -> bool:
        if node.name in _HEADINGS or node.name == "dt":
            return True
        if self.first_link(node) is not None or not 2 <= len(node.text()) <= 150:
            return False
        return node.name in ("li", "p") or any(n.name in ("b", "strong", "i", "em") for n in node.walk())

    def items(self, content: str = "mw-parser-output") -> list[tuple[str, str]]:
        """Titles of texts and sections in order, each title once."""
        main = next((n for n in self.root.walk() if content in n.classes() or n.name == content), None)
        if main is None:
            return []
        found: list[tuple[str, str]] = []

        def linked(node: Node) -> None:
            a = self.first_link(node)
            if a is not None:
                title = a.attrs.get("title") or self.href_title(a.attrs.get("href", ""))
                found.append((title, "POEM"))

        for node in main.walk():
            if node.name in ("ul", "ol", "dl"):
                for item in (c for c in node.children if isinstance(c, Node) and c.name == ("dd" if node.name == "dl" else "li")):
                    if self.is_section(item):
                        found.append((item.text(), "SECTION_TITLE"))
                    else:
                        linked(item)
            elif node.name in ("h1", "h2", "h3", "h4", "p", "div"):
                if self.is_section(node):
                    found.append((node.text(), "SECTION_TITLE"))
                else:
                    linked(node)
        return _firsts(found)


def _firsts(found: list[tuple[str, str]]) -> list[tuple[str, str]]:
    kept: dict[str, str] = {}
    for title, kind in found:
        if title:
            kept.setdefault(title, kind)
    return list(kept.items())


def hub_titles(root: Node, page: _Page) -> list[str]:
    """Titles of linked pages that name this one: versions of a text."""
    plain = lambda s: re.sub(r"\s+", " ", re.sub(r"\s*\([^)]*\)", "", s)).strip().lower()
    own, out = plain(page.title), {}
    for a in root.walk():
        href = a.attrs.get("href", "") if a.name == "a" else ""
        if not href.startswith(("/wiki/", "./")) or "redlink=1" in href or "action=edit" in href:
            continue
        title = page.href_title(href)
        if title and not title.startswith(page.ignored) and (own in plain(title) or title.startswith(f"{page.title}/")):
            out[title] = None
    return list(out)


# -- metadata -------------------------------------------------------------------------------------------

# fixed values: itemprop names and what they fill
_ITEMPROPS = {
    "author": "author",
    "datePublished": "publication_date",
    "isPartOf": "source_collection",
    "publisher": "publisher",
    "translator": "translator",
}


def itemprops(root: Node) -> dict[str, str]:
    first: dict[str, Node] = {}
    for n in root.walk():
        if "itemprop" in n.attrs:
            for prop in n.attrs["itemprop"].split():
                first.setdefault(prop, n)
    out = {}
    for prop, name in _ITEMPROPS.items():
        node = first.get(prop)
        if node is None:
            continue
        value = ""
        if prop == "isPartOf" and (a := next((n for n in node.walk() if n.name == "a"), None)):
            span = next((n for n in a.walk() if n.name == "span" and n.attrs.get("itemprop") == "name"), a)
            value = span.text()
        value = value or node.text() or node.attrs.get("content", "").strip()
        if value:
            out[name] = value
    return out


def templates(wikitext: str) -> list[tuple[str, dict[str, str]]]:
    """Templates in order of their opening braces: name and arguments (positional ones by number).

    One pass: each open template keeps where its own bars are; bars in links or in inner templates are not its own.
    """
    opened: list[tuple[int, list[int], list[int]]] = []  # start, bars, depth of links
    found = []
    for m in re.finditer(r"\{\{|\}\}|\[\[|\]\]|\|", wikitext):
        if m[0] == "{{":
            opened.append((m.start(), [], [0]))
        elif not opened:
            continue
        elif m[0] == "}}":
            start, bars, _ = opened.pop()
            found.append((start, m.start(), bars))
        elif m[0] != "|":
            opened[-1][2][0] += 1 if m[0] == "[[" else -1
        elif opened[-1][2][0] == 0:
            opened[-1][1].append(m.start())
    out = []
    for start, end, bars in sorted(found):
        parts = [wikitext[a:b] for a, b in zip([start + 2, *(x + 1 for x in bars)], [*bars, end], strict=True)]
        args, n = {}, 0
        for p in parts[1:]:
            name, eq, value = p.partition("=")
            if eq and not re.search(r"\{\{|\[\[", name):
                args[name.strip()] = value.strip()
            else:
                n += 1
                args[str(n)] = p.strip()
        out.append((parts[0].strip(), args))
    return out


def _without_templates(code: str) -> str:
    """Pairs of double braces go with what they hold, unless a brace without a partner is left inside."""
    out: list[str] = []
    opened: list[list] = []  # where in ``out``, and whether all inside is gone
    at = 0
    for m in re.finditer(r"\{+|\}+", code):
        out.append(code[at : m.start()])
        at, n = m.end(), len(m[0])
        lone = m[0][0] if n % 2 else ""
        if m[0][0] == "{":
            out.append(lone)
            if lone and opened:
                opened[-1][1] = False
            for _ in range(n // 2):
                opened.append([len(out), True])
                out.append("{{")
            continue
        for _ in range(n // 2):
            if opened and opened[-1][1]:
                del out[opened.pop()[0] :]
                continue
            if opened:
                opened.pop()
            out.append("}}")
            if opened:
                opened[-1][1] = False
        out.append(lone)
        if lone and opened:
            opened[-1][1] = False
    return "".join(out) + code[at:]


def _stripped(code: str) -> str:
    """Wikitext without its markup."""
    code = _without_templates(code)
    code = re.sub(r"\[\[(?:[^\[\]|]*\|)?([^\[\]]*)\]\]", r"\1", code)
    return re.sub(r"<[^>]*>|'{2,}", "", code).strip()


# fixed values: names of templates, their arguments and what they fill
_AUTHOR_TEMPLATES = ("auteur", "author")
_TITLE_TEMPLATE, _TITLE_ARGS = "titre", (("auteur", "author"), ("recueil", "source_collection"))
_EDITION_TEMPLATE, _EDITION_ARGS = "infoédit", (("ANNÉE", "publication_date"), ("RECUEIL", "source_collection"))


def wikitext_metadata(wikitext: str | None) -> dict[str, str]:
    """Author, date and collection from templates; the first value of each stays, even if empty."""
    out: dict[str, str] = {}
    for name, args in templates(wikitext or ""):
        kind = name.lower()
        if kind in _AUTHOR_TEMPLATES and "1" in args:
            out.setdefault("author", args["1"])
        elif kind == _TITLE_TEMPLATE:
            for arg, key in _TITLE_ARGS:
                if arg in args:
                    out.setdefault(key, args[arg])
        elif kind == _EDITION_TEMPLATE:
            if "AUTEUR" in args:
                link = re.search(r"\[\[([^\[\]|]*)", args["AUTEUR"])
                out.setdefault("author", link[1].split(":")[-1].strip() if link else _stripped(args["AUTEUR"]))
            for arg, key in _EDITION_ARGS:
                if arg in args:
                    out.setdefault(key, _stripped(args[arg]))
    return out


# -- the UDF --------------------------------------------------------------------------------------------

_SIGNALS = ("wikidata", "ws_summary", "toc", "editions_header", "list_items")
PARSED = (
    ", ".join(f"{s} boolean" for s in _SIGNALS)
    + ", block_texts array<string>, raw_markers array<string>, items array<struct<title:string,kind:string>>, sub_titles array<string>, "
    + ", ".join(f"{m} string" for m in _ITEMPROPS.values())
    + ", error string"
)


def parse(html: str | None, title: str | None, lang: str = "fr", block: str = "poem", content: str = "mw-parser-output") -> dict:
    root = tree(html)
    nodes = list(root.walk())
    page = _Page(root, title or "", lang)
    texts, markers = verse_blocks(root, block)
    editions = (n.only_string() or "" for n in nodes if n.name in ("h2", "h3"))
    out = {
        "wikidata": any(n.name == "a" and re.match(r"d:Q[0-9]+", n.attrs.get("title", "")) for n in nodes),
        "ws_summary": any(n.name == "div" and "ws-summary" in n.classes() for n in nodes),
        "toc": any(n.name == "div" and n.attrs.get("id") == "toc" for n in nodes),
        "editions_header": any(re.search(r"(?i)éditions", s) for s in editions),
        "list_items": any(n.name == "ul" and any(isinstance(c, Node) and c.name == "li" for c in n.children) for n in nodes),
        "block_texts": texts,
        "raw_markers": markers,
        "items": [{"title": a, "kind": b} for a, b in page.items(content)],
        "sub_titles": hub_titles(root, page),
    }
    return out | {m: None for m in _ITEMPROPS.values()} | itemprops(root) | {"error": None}


def _contained(html, title, *how) -> dict:
    """What ``parse`` gives; of a page that it cannot read, only the error."""
    try:
        return parse(html, title, *how)
    except Exception as e:  # one page must not end the run
        return {"error": f"{type(e).__name__}: {e}"[:200]}


def parse_page(html: Column, title: Column, lang: str = "fr", block: str = "poem", content: str = "mw-parser-output") -> Column:
    """All that the tree of a page gives, as one struct; where a page cannot be read, all but ``error`` is null."""

    @F.pandas_udf(PARSED)
    def run(html: pd.Series, title: pd.Series) -> pd.DataFrame:
        names = [p.split()[0] for p in PARSED.split(", ")]
        found = [_contained(h, x, lang, block, content) for h, x in zip(html, title, strict=True)]
        return pd.DataFrame({n: pd.Series([x.get(n) for x in found], dtype=object) for n in names})

    return run(html, title)


def wikitext(c: Column) -> Column:
    """Struct of the metadata that templates give."""
    names = ("author", "publication_date", "source_collection")

    def contained(code: str | None) -> dict:
        try:
            return wikitext_metadata(code)
        except Exception:  # as if there were no templates
            return {}

    @F.pandas_udf(", ".join(f"{n} string" for n in names))
    def run(code: pd.Series) -> pd.DataFrame:
        found = [contained(x) for x in code]
        return pd.DataFrame({n: pd.Series([x.get(n) for x in found], dtype=object) for n in names})

    return run(c)


# fixed values: categories that decide a page's type
_BOOKS, _EDITIONS = "Recueils de poèmes", "Éditions multiples"
# fixed values: why a page gives no record
UNREADABLE, NO_STANZAS = "PageProcessingError", "PoemParsingError"


def stanzas(parsed: Column) -> Column:
    return F.flatten(F.transform(parsed["block_texts"], t.split_stanzas))


def page_type(parsed: Column, namespace: Column, title: Column, categories: Column, lang: str = "fr") -> Column:
    """struct<type, reason>: the first rule that holds; null for a page that could not be read."""
    cats = F.transform(categories, t.after_colon)
    has = lambda name: F.coalesce(F.array_contains(cats, name), F.lit(False))
    out = lambda kind, reason: F.struct(F.lit(kind).alias("type"), F.lit(reason).alias("reason"))
    poem, hub, book, other = "POEM", "MULTI_VERSION_HUB", "POETIC_COLLECTION", "OTHER"
    case = F.when(parsed["error"].isNotNull(), F.lit(None))
    case = case.when((namespace != 0) & title.startswith(f"{lk.prefix(lang, 'author')}:"), out("AUTHOR", "is_author_page"))
    case = case.when(namespace != 0, out(other, "is_other_namespace"))
    case = case.when(has(_BOOKS), out(book, "is_recueil_cat")).when(has(_EDITIONS), out(hub, "is_multiversion_cat"))
    for key in ("ws_summary", "toc", "editions_header"):
        case = case.when(parsed[key] & parsed["wikidata"], out(hub, f"has_donnees_structurees and {key}")).when(parsed[key], out(book, key))
    case = case.when(F.size(stanzas(parsed)) > 0, out(poem, "has_poem_structure"))
    case = case.when(parsed["wikidata"] & parsed["list_items"], out(hub, "has_donnees_structurees and has_list_items"))
    return case.otherwise(out(other, "no_signals_matched"))


def classify(pages: DataFrame, lang: str = "fr", block: str = "poem", content: str = "mw-parser-output") -> DataFrame:
    """pages: page_id, title, namespace, categories, html. Adds parsed, type, reason; the page is parsed once."""
    parsed = pages.withColumn("parsed", parse_page(F.col("html"), F.col("title"), lang, block, content))
    typed = parsed.withColumn("_t", page_type(F.col("parsed"), F.col("namespace"), F.col("title"), F.col("categories"), lang))
    return typed.withColumn("type", F.col("_t.type")).withColumn("reason", F.col("_t.reason")).drop("_t")


def rejects(classified: DataFrame) -> DataFrame:
    """page_id, title, reject, detail: pages that could not be read, and poems without a stanza."""
    error = F.col("parsed.error")
    empty = (F.col("type") == "POEM") & (F.size(stanzas(F.col("parsed"))) == 0)
    reject = F.when(error.isNotNull(), F.lit(UNREADABLE)).when(empty, F.lit(NO_STANZAS))
    rows = classified.withColumn("reject", reject).where(F.col("reject").isNotNull())
    return rows.select("page_id", "title", "reject", F.coalesce(error, F.lit("no stanza")).alias("detail"))
