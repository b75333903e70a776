"""String expressions of the data model: token count, slugs, headers, hosts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def offline_tokens(text: Column) -> Column:
    """The token count used without a vocabulary: a quarter of the code points, at least 1; null for null."""
    return F.when(text.isNotNull(), F.greatest(F.lit(1), F.floor(F.length(text) / 4).cast("int")))


def host_of(url: Column) -> Column:
    """The host of an absolute url; null when there is none."""
    host = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)", 1)
    return F.when(host != "", host)


def base_url(url: Column) -> Column:
    """The url without its fragment."""
    return F.substring_index(url, "#", 1)


def slug_of(url: Column) -> Column:
    """Last path segment without its extension; the fragment stays; ``unknown`` for an empty url."""
    last = F.element_at(F.split(F.rtrim(F.coalesce(url, F.lit("")), F.lit("/")), "/"), -1)
    slug = F.replace(last, F.lit(".asp"), F.lit(""))
    return F.when(slug == "", F.lit("unknown")).otherwise(slug)


def file_name_of(url: Column) -> Column:
    """A file name for a url: its slug with other characters than word characters as ``_``, at most 120 long."""
    last = F.element_at(F.split(F.rtrim(F.coalesce(url, F.lit("")), F.lit("/")), "/"), -1)
    return F.left(F.regexp_replace(last, r"[^\w]", "_"), F.lit(120))


def context_header(date: Column, slug: Column, speaker: Column, collection: Column, page: Column) -> Column:
    """The bracketed line before a passage; null or empty parts are left out, a page of 0 is kept."""

    def part(label: str, c: Column) -> Column:
        c = c.cast("string")
        return F.when(c != "", F.concat(F.lit(label + ": "), c))

    return F.concat(
        F.lit("["),
        F.concat_ws(
            " | ",
            part("Date", date),
            F.concat(F.lit("Source: "), slug),
            part("Speaker", speaker),
            F.concat(F.lit("Collection: "), collection),
            part("Page", page),
        ),
        F.lit("]"),
    )


def word_count(text: Column) -> Column:
    """White-space separated pieces, Unicode white space included; 0 for null."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)^\s+|\s+$", "")
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, r"(?U)\s+")))
