"""Problem 6: oversized items cut into pieces under their limit, at natural boundaries and with an overlap.

Cuts are sought by a hierarchy: before a section heading, after a paragraph, after a sentence, after a word, and between
characters only where nothing else is left. Parts are packed greedily; each piece after the first begins ``overlap``
tokens before its predecessor's end, moved back to the beginning of a word where there is one within the overlap.
Every piece is a substring, so the text is got back from the parts beyond the overlaps.

Nulls: an item with a null text has no piece, one with a null limit stays whole; a null overlap is 0, and an overlap of
more than half of the limit counts as half. An empty text is one piece. Repeated items are split alike. Only items over
their limit leave the JVM.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.functions.text import offline_tokens
from inkwell.llm.batches import map_columns

#: The hierarchy: matches end where a cut may be made. A section begins with a line of capitals or a numbered heading.
LEVELS = tuple(
    re.compile(p)
    for p in (
        r"\n(?=(?:ARTICLE|ANNEX|SECTION|CHAPTER|SCHEDULE|COUNT|Count|Article|Section|Chapter)\b[^\n]{0,80}(?:\n|$)|[^a-z\n]{6,80}(?:\n|$))",
        r"\n\s*\n+|\n",
        r"(?<=[.!?…])[\"'”»)\]]*\s+",
        r"\s+",
    )
)
CHARS_A_TOKEN = 4


def unit_ends(text: str, room: int) -> list[int]:
    """Where parts of at most ``room`` characters end, cut at the highest level that serves."""
    ends: list[int] = []
    todo = [(0, len(text), 0)]
    while todo:
        lo, hi, level = todo.pop()
        if hi - lo <= room:
            ends.append(hi)
        elif level == len(LEVELS):
            ends.extend(range(lo + room, hi, room))
            ends.append(hi)
        else:
            cuts = [m.end() for m in LEVELS[level].finditer(text, lo, hi) if lo < m.end() < hi]
            edges = [lo, *cuts, hi]
            todo.extend((a, b, level + 1) for a, b in zip(reversed(edges[:-1]), reversed(edges[1:])))
    return ends


def split_spans(text: str, max_tokens: int, overlap_tokens: int) -> list[tuple[int, int]]:
    """Begin and end of each piece; every piece has at most ``max_tokens`` tokens by the offline count."""
    limit = CHARS_A_TOKEN * max(1, max_tokens) + CHARS_A_TOKEN - 1
    if len(text) <= limit:
        return [(0, len(text))]
    back = CHARS_A_TOKEN * max(0, min(overlap_tokens, max_tokens // 2))
    slack = min(40, limit // 8) if back else 0
    ends = unit_ends(text, limit - back - slack)
    spans, begin, k = [], 0, 0
    while k < len(ends):
        first = k
        while k < len(ends) and ends[k] - begin <= limit:
            k += 1
        assert k > first
        end = ends[k - 1]
        spans.append((begin, end))
        if k < len(ends):
            begin = end - back
            if back:
                low = max(spans[-1][0] + 1, begin - slack)
                for at in range(begin, low, -1):
                    if text[at - 1].isspace() and not text[at].isspace():
                        begin = at
                        break
    return spans


def split_items(items: DataFrame, keys: list[str]) -> DataFrame:
    """Pieces of ``items(keys..., text, max_tokens, overlap_tokens)``.

    Gives keys, piece_no (from 1), n_pieces, begin, end, tokens, piece. Other columns of ``items`` are dropped.
    """
    cols = [*keys, "text", "max_tokens", "overlap_tokens"]
    items = items.select(*cols).where(F.col("text").isNotNull())
    big = F.coalesce(offline_tokens(F.col("text")) > F.col("max_tokens"), F.lit(False))
    whole = items.where(~big).select(
        *keys,
        F.lit(1).cast("bigint").alias("piece_no"),
        F.lit(1).cast("bigint").alias("n_pieces"),
        F.lit(0).cast("bigint").alias("begin"),
        F.length("text").cast("bigint").alias("end"),
        offline_tokens(F.col("text")).cast("bigint").alias("tokens"),
        F.col("text").alias("piece"),
    )
    types = dict(items.dtypes)
    schema = ", ".join(f"`{k}` {types[k]}" for k in keys) + (
        ", piece_no bigint, n_pieces bigint, begin bigint, `end` bigint, tokens bigint, piece string"
    )

    def kernel(c: dict, _) -> dict:
        out: dict[str, list] = {k: [] for k in [*keys, "piece_no", "n_pieces", "begin", "end", "tokens", "piece"]}
        for i, text in enumerate(c["text"]):
            spans = split_spans(text, c["max_tokens"][i], c["overlap_tokens"][i] or 0)
            for n, (a, b) in enumerate(spans, 1):
                for k in keys:
                    out[k].append(c[k][i])
                for k, v in (("piece_no", n), ("n_pieces", len(spans)), ("begin", a), ("end", b), ("tokens", max(1, (b - a) // CHARS_A_TOKEN)), ("piece", text[a:b])):
                    out[k].append(v)
        return out

    return whole.unionByName(map_columns(items.where(big), kernel, schema))
