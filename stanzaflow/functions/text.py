"""Text expressions. White space is Unicode white space, as ``(?U)\\s`` matches it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import METADATA

# fixed values: canonical author names, looked up without regard to case
AUTHOR_NAMES = {
    "A. de Lamartine": "Alphonse de Lamartine",
    "Lamartine": "Alphonse de Lamartine",
    "Nikolaus Becker,Alphonse de Lamartine": "Nikolaus Becker, Alphonse de Lamartine",
    "Tarass Chevtchenko": "Taras Chevtchenko",
    "Taras grigoriévitch chevtchenko": "Taras Chevtchenko",
    "Oscar Vladislas de Lubicz Milosz": "Oscar Venceslas de Lubicz-Milosz",
    "Oscar Venceslas de Lubicz-Milosz": "Oscar Venceslas de Lubicz-Milosz",
}


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def collapse(c: Column) -> Column:
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


def truthy(c: Column) -> Column:
    """Neither null nor empty."""
    return F.coalesce(c != "", F.lit(False))


def present(c: Column) -> Column:
    """An id that is neither null nor 0."""
    return F.coalesce(c != 0, F.lit(False))


def nonblank(c: Column) -> Column:
    return F.coalesce(F.length(strip(c)) > 0, F.lit(False))


def without_parentheses(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\s*\([^)]*\)", "")


def last_segment(c: Column) -> Column:
    """What follows the last slash."""
    return F.element_at(F.split(c, "/"), -1)


def after_colon(c: Column) -> Column:
    """What follows the last colon."""
    return F.element_at(F.split(c, ":"), -1)


def clean_title(c: Column) -> Column:
    """Last path segment without parentheses; the stripped title where nothing is left."""
    bare = collapse(without_parentheses(last_segment(c)))
    return F.when(F.length(bare) > 0, bare).otherwise(strip(c))


def clean_author(c: Column) -> Column:
    name = strip(c)
    # fixed values: what surrounds names
    steps = [
        (r"(?U)^[Aa]uteur\s*:\s*", ""),
        (r"(?iuU)\s*-\s*non signé", ""),
        (r"(?iuU)\s*,?\s*auteur du texte", ""),
        (r"(?iu)Traduit par.*$", ""),
        (r"([;,])([A-Z])", "$1 $2"),
    ]
    out = name
    for pattern, new in steps:
        out = F.regexp_replace(out, pattern, new)
    known = F.create_map(*[F.lit(x) for key, canonical in AUTHOR_NAMES.items() for x in (key.lower(), canonical)])

    def bare(c: Column) -> Column:
        return collapse(F.when(c.rlike(r"^\((.*?)\)$"), strip(F.regexp_extract(c, r"^\((.*?)\)$", 1))).otherwise(c))

    def canonical(c: Column) -> Column:
        return F.coalesce(F.try_element_at(known, F.lower(c)), c)

    # each step is bound to a name, or its expression would be copied wherever the next one uses it
    for step in (bare, canonical):
        out = F.element_at(F.transform(F.array(out), step), 1)
    return F.when(F.length(name) > 0, out).otherwise(name)


def richness(text: str = "normalized_text") -> Column:
    """How much a record knows: ids, section, hub, metadata and length of its text."""
    score = F.when(F.col("collection_page_id").isNotNull(), 50).otherwise(0)
    score += F.when(F.col("section_title").isNotNull(), 20).otherwise(0)
    hub = F.col("hub_page_id").isNotNull() & ~F.col("hub_page_id").eqNullSafe(F.col("page_id"))
    score += F.when(hub, 30).otherwise(0)
    for m in METADATA:
        score += F.when(nonblank(F.col(f"metadata.{m}")), 10).otherwise(0)
    return (score + F.coalesce(F.floor(F.length(text) / 100), F.lit(0))).cast("long")


def joined_stanzas(stanzas: Column) -> Column:
    return F.array_join(F.transform(stanzas, lambda s: F.array_join(s, "\n")), "\n\n")


def split_stanzas(text: Column) -> Column:
    """Verses by line, stanzas by blank line; empty ones go."""
    lines = F.transform(F.split(F.replace(text, F.lit("\xa0"), F.lit(" ")), "\n"), strip)
    blocks = F.split(F.regexp_replace(F.array_join(lines, "\n"), r"\n{2,}", "\n\n"), "\n\n")
    stanzas = F.transform(blocks, lambda b: F.filter(F.split(b, "\n"), lambda v: F.length(v) > 0))
    return F.filter(stanzas, lambda s: F.size(s) > 0)


def checksum(wikitext: Column) -> Column:
    return F.sha2(wikitext, 256)


def source_fallback(source: Column, title: Column) -> Column:
    """A missing source collection is the first path segment of the title, if shorter than 70."""
    first = strip(F.element_at(F.split(title, "/"), 1))
    found = F.when(title.contains("/") & (F.length(first) < 70), first)
    return F.when(truthy(source), source).otherwise(found)


def underscored(c: Column) -> Column:
    return F.translate(c, " ", "_")


def spaced(c: Column) -> Column:
    return F.translate(c, "_", " ")


def file_name(c: Column) -> Column:
    """A name safe for files."""
    return F.lower(F.regexp_replace(c, r'[\\/*?:"<>| ]', "_"))


def url_path(title: Column) -> Column:
    """A title as the path of its page: underscores, percent-escaped but for slashes."""
    escaped = F.url_encode(underscored(title))
    for old, new in (("+", "%20"), ("%2F", "/"), ("*", "%2A"), ("%7E", "~")):
        escaped = F.replace(escaped, F.lit(old), F.lit(new))
    return escaped


def page_url(language: Column, title: Column) -> Column:
    return F.concat(F.lit("https://"), language, F.lit(".wikisource.org/wiki/"), url_path(title))
