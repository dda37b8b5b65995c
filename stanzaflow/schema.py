"""The corpus record and its rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

METADATA = ("author", "publication_date", "source_collection", "publisher", "translator")
_INFO = "title:string,page_id:bigint,url:string"
#: A section has ``poems``, a poem has ``page_id``; both stand in one ordered list.
COLLECTION = f"struct<page_id:bigint,title:string,author:string,url:string,content:array<struct<{_INFO},poems:array<struct<{_INFO}>>>>>"
RECORD = ", ".join(
    [
        "page_id bigint",
        "revision_id bigint",
        "title string",
        "language string",
        "wikisource_url string",
        "collection_page_id bigint",
        "collection_title string",
        "section_title string",
        "poem_order int",
        "hub_title string",
        "hub_page_id bigint",
        "metadata struct<" + ",".join(f"{m}:string" for m in METADATA) + ">",
        "structure struct<stanzas:array<array<string>>,raw_markers:array<string>>",
        f"collection_structure {COLLECTION}",
        "normalized_text string",
        "raw_wikitext string",
        "checksum_sha256 string",
        "extraction_timestamp timestamp",
        "provenance string",
    ]
)
#: The flat index row of a record.
INDEX_COLUMNS = (
    "page_id",
    "title",
    "author",
    "publication_date",
    "language",
    "checksum_sha256",
    "extraction_timestamp",
    "collection_page_id",
    "collection_title",
    "section_title",
    "poem_order",
    "hub_title",
    "hub_page_id",
)
PAGE_TYPES = ("POEM", "POETIC_COLLECTION", "MULTI_VERSION_HUB", "AUTHOR", "DISAMBIGUATION", "OTHER", "SECTION_TITLE")

_INT = r"^\s*-?[0-9]+\s*$"
_REQUIRED_TEXT = ("title", "language", "wikisource_url", "normalized_text", "raw_wikitext", "checksum_sha256")
_OPTIONAL_TEXT = ("collection_title", "section_title", "hub_title")


def _part(v: Column, path: str) -> Column:
    return F.try_variant_get(v, f"$.{path}", "variant")


def _kind(v: Column, path: str) -> Column:
    """BIGINT, STRING, ... or null when missing or JSON null."""
    kind = F.schema_of_variant(_part(v, path))
    return F.when(kind != "VOID", kind)


def problems(v: Column) -> Column:
    """Names of the fields of a parsed record (variant) that break a rule, in order."""

    def integer(name: str, required: bool) -> Column:
        text = F.try_variant_get(v, f"$.{name}", "string")
        kind = _kind(v, name)
        good = (kind == "BIGINT") | ((kind == "STRING") & text.rlike(_INT)) | (kind.startswith("DECIMAL") & text.rlike(r"^-?[0-9]+(\.0*)?$"))
        return F.when(kind.isNull(), F.lit(required)).otherwise(~good)

    def text(name: str, required: bool) -> Column:
        kind = _kind(v, name)
        return F.when(kind.isNull(), F.lit(required)).otherwise(kind != "STRING")

    def bad(name: str, wrong: Column) -> Column:
        return F.when(F.coalesce(wrong, F.lit(True)), F.lit(name))

    checks = [bad(n, integer(n, True)) for n in ("page_id", "revision_id", "hub_page_id")]
    checks += [bad(n, integer(n, False)) for n in ("collection_page_id", "poem_order")]
    checks += [bad(n, text(n, True)) for n in _REQUIRED_TEXT] + [bad(n, text(n, False)) for n in _OPTIONAL_TEXT]
    checks += [bad(f"metadata.{m}", text(f"metadata.{m}", False)) for m in METADATA]
    checks.append(bad("metadata", ~F.coalesce(_kind(v, "metadata").startswith("OBJECT"), F.lit(False))))
    stanzas = F.try_variant_get(v, "$.structure.stanzas", "array<array<string>>")
    markers = F.try_variant_get(v, "$.structure.raw_markers", "array<string>")
    hollow = F.exists(stanzas, lambda s: s.isNull() | F.exists(s, lambda v: v.isNull())) | F.exists(markers, lambda m: m.isNull())
    checks.append(bad("structure", stanzas.isNull() | markers.isNull() | hollow))
    url = F.try_variant_get(v, "$.wikisource_url", "string")
    checks.append(bad("wikisource_url.scheme", url.isNotNull() & ~url.rlike(r"(?i)^https?://[^/?#\s]+")))
    source = F.try_variant_get(v, "$.provenance", "string")
    checks.append(bad("provenance", source.isNotNull() & ~source.isin("api", "dump")))
    return F.array_compact(F.array(*checks))
