"""Links of a page, by native functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import spaced

# fixed values: localized prefixes
PREFIXES = {
    "fr": {"category": "Catégorie", "author": "Auteur"},
    "en": {"category": "Category", "author": "Author"},
}
CATEGORY_PREFIXES = {"fr": "Catégorie", "en": "Category", "de": "Kategorie", "es": "Categoría", "it": "Categoria"}
IGNORED = ("Portail", "Aide", "Wikisource", "Fichier", "Spécial", "Livre", "Discussion", "Modèle", "Projet")
_HREF = r'<a[^>]*href="([^"]*)"'


def prefix(lang: str, kind: str) -> str:
    return PREFIXES.get(lang, {}).get(kind, kind.capitalize())


def category_prefix(lang: str) -> str:
    return CATEGORY_PREFIXES.get(lang, "Category")


def ignored_prefixes(lang: str) -> list[str]:
    return [prefix(lang, "category"), prefix(lang, "author"), *IGNORED]


def href_title(href: Column) -> Column:
    """The title that an internal href names; empty for any other. ``+`` stays; bad escapes leave it as it is."""
    inner = F.when(href.startswith("/wiki/"), F.substr(href, F.lit(7))).when(href.startswith("./"), F.substr(href, F.lit(3)))
    inner = F.element_at(F.split(inner, "#"), 1)
    decoded = F.try_url_decode(F.replace(inner, F.lit("+"), F.lit("%2B")))
    return F.coalesce(spaced(F.coalesce(decoded, inner)), F.lit(""))


def internal(href: Column, title: Column, lang: str = "fr") -> Column:
    """Whether a link leads to a page that may be a text: no edit link, no red link, no service namespace."""
    service = "|".join(ignored_prefixes(lang))
    good = href.startswith("/wiki/") | href.startswith("./")
    return good & ~href.contains("&redlink=1") & ~href.contains("action=edit") & (title != "") & ~title.rlike(f"^(?:{service}):")


def hrefs(pages: DataFrame, html: str = "html") -> DataFrame:
    """page_id, pos (from 0), href: all links in order."""
    found = F.regexp_extract_all(F.col(html), F.lit(_HREF), F.lit(1))
    return pages.select("page_id", F.posexplode(found).alias("pos", "href"))


def titled(pages: DataFrame, html: str = "html") -> DataFrame:
    return hrefs(pages, html).withColumn("link_title", href_title(F.col("href")))


def first_by_title(links: DataFrame) -> DataFrame:
    """Of links to one title on a page, the first."""
    return links.groupBy("page_id", "link_title").agg(F.min("pos").alias("pos"))
