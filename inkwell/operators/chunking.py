"""Documents to token-budgeted passages.

Turns are packed greedily by an ordered fold; long texts are split over separators with a carried-over tail. The whole
table keeps one row per passage: chunk_id, text, body, collection, source_url, date_iso, speaker, page_number, token_count,
chunk_index, total_chunks, slug.

Nulls: null and blank texts give no passage; a null turns array is an empty one; documents flagged as stubs or without
words are skipped. A unit above the budget becomes a passage of its own.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwell.functions.text import context_header, offline_tokens, slug_of
from inkwell.operators.arrow import map_columns

SESSION_TARGET, SESSION_MAX, JUDGMENT_MAX, FLAT_MAX, OVERLAP = 400, 512, 600, 512, 64


def n_tokens(text: str) -> int:
    """The token count used without a vocabulary."""
    return max(1, len(text) // 4)


def pack_ids(tokens: Column, budget: int) -> Column:
    """The passage number (from 0) of each unit of an ordered array of token counts: a unit opens a new passage when it
    does not fit into the current one."""
    start = F.struct(F.array().cast("array<int>").alias("ids"), F.lit(0).alias("at"), F.lit(0).cast("bigint").alias("sum"))

    def step(acc, t):
        opens = (acc["sum"] > 0) & (acc["sum"] + t > budget)
        at = acc["at"] + F.when(opens, 1).otherwise(0)
        total = F.when(opens, t).otherwise(acc["sum"] + t).cast("bigint")
        return F.struct(F.concat(acc["ids"], F.array(at)).alias("ids"), at.alias("at"), total.alias("sum"))

    return F.aggregate(tokens, start, step, lambda a: a["ids"])


def sentence_pieces(text: Column, budget: int) -> Column:
    """A text cut after sentences into pieces whose sentences together keep the budget; a long sentence stays whole."""
    parts = F.split(text, r"(?<=[.!?])\s+")
    ids = pack_ids(F.transform(parts, lambda p: offline_tokens(p)), budget)
    both = F.arrays_zip(ids.alias("i"), parts.alias("p"))
    numbers = F.sequence(F.lit(0), F.array_max(ids))
    return F.transform(numbers, lambda n: F.array_join(F.transform(F.filter(both, lambda x: x["i"] == n), lambda x: x["p"]), " "))


def packed_turns(turns: DataFrame, budget: int = SESSION_TARGET, longest: int = SESSION_MAX) -> DataFrame:
    """Passages of ``turns(doc, turn_no, speaker, text, page)``: doc, chunk_index, n_turns, speaker and page of the first
    turn, tokens (of the units with their labels), body. A turn above ``longest`` is first cut after sentences."""
    kept = turns.where(F.trim(F.coalesce("text", F.lit(""))) != "").withColumn("text", F.trim("text"))
    units = F.when(offline_tokens(F.col("text")) > longest, sentence_pieces(F.col("text"), longest)).otherwise(F.array("text"))
    pieces = kept.select("doc", "turn_no", "speaker", "page", F.posexplode(units).alias("part", "unit"))
    label = F.when(F.coalesce("speaker", F.lit("")) != "", F.concat("speaker", F.lit(": ")))
    pieces = pieces.withColumn("unit", F.concat(F.coalesce(label, F.lit("")), F.trim("unit")))
    row = F.struct("turn_no", "part", "speaker", "page", "unit", offline_tokens(F.col("unit")).alias("t"))
    docs = pieces.groupBy("doc").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    ids = pack_ids(F.col("rows.t"), budget)
    each = docs.select("doc", F.posexplode(F.arrays_zip(ids.alias("i"), F.col("rows").alias("r"))).alias("k", "x"))
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("k", F.col("x.r.unit").alias("s")))), lambda y: y["s"]), "\n")
    return each.groupBy("doc", F.col("x.i").cast("bigint").alias("chunk_index")).agg(
        F.count_distinct("x.r.turn_no").alias("n_turns"), F.min_by("x.r.turn_no", "k").cast("bigint").alias("first_turn"),
        F.min_by("x.r.speaker", "k").alias("speaker"), F.min_by("x.r.page", "k").cast("bigint").alias("page"),
        F.sum("x.r.t").cast("bigint").alias("tokens"), body.alias("body"),
    )


def tail_of(text: str, tokens: int) -> str:
    """The last whole words of a text that keep ``tokens``."""
    words = text.split()
    from_the_end = list(accumulate(n_tokens(w) for w in reversed(words)))
    return " ".join(words[len(words) - bisect_right(from_the_end, tokens) :])


def _joined(parts: list[str], sep: str, budget: int, overlap: int) -> list[str]:
    """Parts joined while they keep the budget; each piece after the first opens with the tail of the one before.

    The cuts are found on the running sum of the parts' sizes: from where a piece's own size is known, the last part that
    still fits is sought by bisection.
    """
    upto = [0, *accumulate(n_tokens(p + sep) for p in parts)]
    at, opening, out = 0, parts[0], []
    room = budget - upto[1]
    while True:
        end = max(at + 1, bisect_right(upto, upto[at + 1] + room) - 1)
        out.append(sep.join([opening, *parts[at + 1 : end]]))
        if end == len(parts):
            return out
        tail = tail_of(out[-1], overlap)
        at, opening = end, sep.join([tail, parts[end]] if tail else [parts[end]])
        room = budget - n_tokens(opening)


def window_pieces(text: str, budget: int, overlap: int) -> list[str]:
    """A text in overlapping pieces: the first separator (blank line, line, sentence, space) over the whole text that
    keeps every piece within the budget, else single words, of which a long one may still be above it."""
    if n_tokens(text) <= budget:
        return [text]
    cut = ((text.split(sep), sep) for sep in ("\n\n", "\n", ". ", " "))
    tries = (_joined(parts, sep, budget, overlap) for parts, sep in cut if len(parts) > 1)
    fitting = (pieces for pieces in tries if all(n_tokens(p) <= budget for p in pieces))
    return next(fitting, None) or _joined(text.split() or [""], " ", budget, overlap)


#: Navigation lines that may stand before a text, and the length below which an unpunctuated line is one.
NAV_LINES = {"previous document", "next document", "judgment contents", "general", "contents", "table of contents"}
NAV_SHORT, NAV_TAIL = 40, 10


def without_navigation(text: str) -> str:
    """A text without leading navigation lines (known ones, and short ones without punctuation) and trailing ones."""
    rows = text.split("\n")
    low = [r.strip().lower() for r in rows]
    begin = next((i for i, r in enumerate(low) if r not in NAV_LINES and (len(r) >= NAV_SHORT or re.search(r"[.,:;?!]", r))), len(rows))
    end = len(rows)
    while end > max(begin, len(rows) - NAV_TAIL) + 1 and (low[end - 1] == "" or low[end - 1] in NAV_LINES):
        end -= 1
    return "\n".join(rows[begin:end]).strip()


HEADING = re.compile(r"^(?:PART\s+[IVXLC]+|CHAPTER\s+\d+|SECTION\s+\d+|[A-Z][A-Z\s]{4,}:?\s*$)", re.M)


def headed_pieces(text: str, budget: int = JUDGMENT_MAX, overlap: int = OVERLAP) -> list[str]:
    """Pieces of a text cut hard at its headings; each piece begins with the heading of its section."""
    marks = list(HEADING.finditer(text))
    edges = [0, *[m.end() for m in marks]]
    ends = [*[m.start() for m in marks], len(text)]
    labels = ["", *[m.group().strip() for m in marks]]
    out = []
    for label, a, b in zip(labels, edges, ends):
        section = text[a:b].strip()
        if section:
            out += [(label + "\n" if label else "") + p.strip() for p in window_pieces(section, budget, overlap) if p.strip()]
    return out


def split_documents(docs: DataFrame) -> DataFrame:
    """Bodies of ``docs(doc, collection, text)``: doc, chunk_index, body. Judgments are cut at headings, others by windows."""

    def kernel(c: dict, _) -> dict:
        out: dict[str, list] = {"doc": [], "chunk_index": [], "body": []}
        for doc, coll, text in zip(c["doc"], c["collection"], c["text"]):
            text = without_navigation(text or "")
            if not text.strip():
                continue
            pieces = headed_pieces(text) if coll == "judgment" else [p for p in window_pieces(text, FLAT_MAX, OVERLAP) if p.strip()]
            for i, p in enumerate(pieces):
                out["doc"].append(doc)
                out["chunk_index"].append(i)
                out["body"].append(p.strip())
        return out

    return map_columns(docs.select("doc", "collection", "text"), kernel, "doc bigint, chunk_index bigint, body string")


def finished(bodies: DataFrame, docs: DataFrame) -> DataFrame:
    """The passage table of ``bodies(doc, chunk_index, body, speaker, page)`` and ``docs(doc, url, date_iso, collection)``."""
    # a document's passages are one text's: their number is bounded by its length
    joined = bodies.join(docs.select("doc", "url", "date_iso", "collection", slug_of(F.col("url")).alias("slug")), "doc")
    header = context_header(F.col("date_iso"), F.col("slug"), F.col("speaker"), F.col("collection"), F.col("page"))
    text = F.concat(header, F.lit("\n"), "body")
    w = Window.partitionBy("doc")
    return joined.select(
        "doc",
        F.concat_ws("::", "collection", "slug", F.format_string("%04d", "chunk_index")).alias("chunk_id"), text.alias("text"), "body", "collection",
        F.col("url").alias("source_url"), "date_iso", "speaker", F.col("page").alias("page_number"), offline_tokens(text).cast("bigint").alias("token_count"),
        "chunk_index", F.count(F.lit(1)).over(w).alias("total_chunks"), "slug",
    )
