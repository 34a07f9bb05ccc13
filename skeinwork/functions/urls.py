"""Article addresses: language, title, revision, folder names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _decode(c: Column) -> Column:
    """Percent-decoding that leaves plus signs; text that cannot be decoded stays as it is."""
    return F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)


def _non_empty(c: Column) -> Column:
    return F.when(c != "", c)


def language(url: Column) -> Column:
    """First label of the host, null if there is none."""
    return _non_empty(F.regexp_extract(url, r"^https?://([^./]+)\.", 1))


def parse_title(url: Column) -> Column:
    """Title from the path after /wiki/, else from the query; decoded, underscores as spaces; null if there is none."""
    path = _non_empty(F.regexp_extract(url, r"^https?://[^/]+/wiki/([^?#]+)", 1))
    query = _non_empty(F.regexp_extract(url, r"[?&]title=([^&#]+)", 1))
    return F.replace(_decode(F.coalesce(path, query)), F.lit("_"), F.lit(" "))


def source_title(url: Column) -> Column:
    """Title from title= anywhere, else from what follows the last /wiki/; decoded; null if there is none."""
    query = _non_empty(F.regexp_extract(url, r"title=([^&]+)", 1))
    path = F.when(F.contains(url, F.lit("/wiki/")), F.regexp_extract(url, r".*/wiki/([^?#]*)", 1))
    return F.replace(_decode(F.coalesce(query, path)), F.lit("_"), F.lit(" "))


def revision(url: Column) -> Column:
    """The oldid of a versioned address as a number, else null."""
    return F.regexp_extract(url, r"[?&]oldid=(\d+)", 1).try_cast("bigint")


def versioned(lang: Column, title: Column, oldid: Column, domain: str = "wikipedia.org") -> Column:
    """Address of one revision, everything in the title percent-encoded."""
    return F.concat(F.lit("https://"), lang, F.lit(f".{domain}/w/index.php?title="), F.url_encode(F.replace(title, F.lit(" "), F.lit("_"))), F.lit("&oldid="), oldid.cast("string"))


def slug(title: Column) -> Column:
    """Folder name: spaces and unsafe characters as single underscores, none at the ends."""
    c = F.regexp_replace(title, r"(?U)\s", "_")
    c = F.regexp_replace(c, r"[\\/:*?\"<>|\x00-\x1f]", "_")
    return F.regexp_replace(F.regexp_replace(c, "_{2,}", "_"), "^_+|_+$", "")


def valid_urls(urls: Column, domain: str = "wikipedia.org") -> Column:
    """Those of an array that are on the domain; an empty array for null."""
    return F.filter(F.coalesce(urls, F.array().cast("array<string>")), lambda u: F.coalesce(F.contains(u, F.lit(f"{domain}/")), F.lit(False)))
