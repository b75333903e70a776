"""Dates written in urls, file names and texts. What is no real day is null; so is a null input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"
SHORT = "Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Sept|Oct|Nov|Dec"
DAYS = "Monday|Tuesday|Wednesday|Thursday|Friday|Saturday|Sunday"


def _day(text: Column, pattern: str) -> Column:
    return F.try_to_date(F.when(text != "", text), pattern)


def url_date(url: Column) -> Column:
    """MM-DD-YY in a url, read as 19YY."""
    found = F.regexp_extract(url, r"(\d{2}-\d{2})-(\d{2})(?!\d)", 0)
    return _day(F.regexp_replace(found, r"^(\d{2}-\d{2})-(\d{2})$", "$1-19$2"), "MM-dd-yyyy")


def file_date(stem: Column) -> Column:
    """MM-DD-YY in a file name; a year above 30 is 19YY, else 20YY."""
    found = F.regexp_extract(stem, r"(\d{2})[-_](\d{2})[-_](\d{2})(?!\d)", 0)
    century = F.when(F.right(found, F.lit(2)).cast("int") > 30, "19").otherwise("20")
    return _day(F.when(found != "", F.concat(F.substring(found, 1, 2), F.substring(found, 4, 2), century, F.right(found, F.lit(2)))), "MMddyyyy")


def written_date(text: Column) -> Column:
    """A whole string like 6 March 1946."""
    return _day(F.regexp_extract(text, rf"^\s*(\d{{1,2}} (?:{MONTHS}) \d{{4}})\s*$", 1), "d MMMM yyyy")


def text_date(text: Column, within: int = 2000) -> Column:
    """The date in the first characters of a text: day and month in words, else month first, else a short form."""
    head = F.left(text, F.lit(within))
    long = _day(F.regexp_extract(head, rf"\b(\d{{1,2}} (?:{MONTHS}) \d{{4}})\b", 1), "d MMMM yyyy")
    us = _day(F.regexp_extract(head, rf"\b((?:{MONTHS}) \d{{1,2}}, \d{{4}})\b", 1), "MMMM d, yyyy")
    day = F.regexp_extract(head, rf"\b(\d{{1,2}}) (?:{SHORT})\.? '?(\d{{2}})\b(?!\d)", 1)
    mon = F.left(F.regexp_extract(head, rf"\b(\d{{1,2}}) ({SHORT})\.? '?(\d{{2}})\b(?!\d)", 2), F.lit(3))
    year = F.regexp_extract(head, rf"\b(\d{{1,2}}) ({SHORT})\.? '?(\d{{2}})\b(?!\d)", 3)
    century = F.when(year.cast("int") > 30, "19").otherwise("20")
    short = _day(F.when(day != "", F.concat_ws(" ", day, mon, F.concat(century, year))), "d MMM yyyy")
    return F.coalesce(long, us, short)


def inferred_date(stem: Column, by_type: Column, text: Column) -> tuple[Column, Column]:
    """File name, then the date of the document type, then the text; and which of them gave it."""
    name, body = file_date(stem), text_date(text)
    source = F.when(name.isNotNull(), "filename").when(by_type.isNotNull(), "doc_type").when(body.isNotNull(), "text").otherwise("none")
    return F.coalesce(name, by_type, body), source


# How a hearing's day and its adjournment are written.
_WRITTEN = r"(\d{1,2}\s+\w+\s+19\d{2})"
_ADJOURNED = rf"(?i)(?:tribunal\s+)?adjourned?\s+(?:until|to|till)\s+(?:(?:{DAYS}),?\s+)?{_WRITTEN}"
_ADJOURNS = r"(?i)will\s+now\s+adjourn|tribunal\s+will\s+(?:now\s+)?adjourn|we\s+will\s+adjourn\s+now|court\s+(?:will\s+)?adjourn|adjourned\s+(?:sine\s+die|indefinitely)"
_HEADERS = (
    rf"(?is)sitting at\s+\S.*?on\s+{_WRITTEN}", rf"(?is)official\s+transcript.*?on\s+{_WRITTEN}",
    rf"(?im)^(?:{DAYS}),?\s+{_WRITTEN}",
)


def _spoken_day(found: Column) -> Column:
    """A day and a month's full name in any case."""
    return _day(F.initcap(F.regexp_replace(found, r"\s+", " ")), "d MMMM yyyy")


def header_date(text: Column) -> Column:
    """The day a transcript's own header names in its first 2000 characters; days of exhibits are not taken."""
    head = F.left(text, F.lit(2000))
    return F.coalesce(*[_spoken_day(F.regexp_extract(head, p, 1)) for p in _HEADERS])


def adjournment(text: Column) -> tuple[Column, Column]:
    """The last day named after 'adjourned until' in the last 3000 characters, and DATE, OPEN or null for what was found."""
    tail = F.right(text, F.lit(3000))
    said = F.regexp_extract_all(tail, F.lit(_ADJOURNED), F.lit(1))
    day = _spoken_day(F.when(F.size(said) > 0, F.element_at(said, -1)))
    kind = F.when(F.size(said) > 0, F.when(day.isNotNull(), "DATE")).when(tail.rlike(_ADJOURNS), "OPEN")
    return day, kind


def title_case(text: Column) -> Column:
    """Every run of letters with a capital, after hyphens too."""
    parts = F.split(F.lower(text), "(?<=[^a-z])|(?=[^a-z])")
    return F.array_join(F.transform(parts, lambda p: F.concat(F.upper(F.left(p, F.lit(1))), F.substr(p, F.lit(2)))), "")


def day_ordinal(text: Column) -> Column:
    """The ordinal of a hearing day in the first 600 characters, as in 'Two Hundred-Seventh Day'."""
    found = F.regexp_extract(F.left(text, F.lit(600)), r"(?i)\b([A-Z][A-Z -]{2,40}?(?:st|nd|rd|th|first|second|third)) day\b", 1)
    return F.when(found != "", title_case(F.trim(found)))


def date_slug(day: Column) -> Column:
    """MM-dd-yy."""
    return F.date_format(day, "MM-dd-yy")


def typed(doc_type: Column, values: dict[str, str]) -> Column:
    """The value that a table of constants gives a document type (dates, speakers); null for other types."""
    pairs = [F.lit(x) for kv in values.items() for x in kv]
    return F.element_at(F.create_map(*pairs), doc_type) if pairs else F.lit(None).cast("string")


def file_speaker(stem: Column, known: list[str]) -> Column:
    """The last word of a file name, in capitals, if it is a known speaker's name."""
    last = F.upper(F.regexp_extract(stem, r"([A-Za-z]+)$", 1))
    return F.when(last.isin(*[k.upper() for k in known]), last)
