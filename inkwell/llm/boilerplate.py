"""Problem 2: the record's own lines of a scraped page, without the furniture of the site.

Every line gets a score from weights trained on labelled pages (``lines``): the words of a record count up, the words and
tags of a site (separators, arrows, short lines, notices) count down. One linear scan finds the contiguous run of lines with
the largest sum: the content region. What lies outside is furniture. The same scan with the signs turned finds the runs
inside the region whose sum falls below ``ISLAND``, furniture between the lines of the record, and outside of it passages
of the record that furniture cuts off, whose sum is above ``PASSAGE``. A line in which a sentence
of the line before goes on, broken by an inline link, scores with that sentence.

Nulls: a null text has no line. An empty text, and an empty line, is no furniture. Very long texts take linear time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm import lines
from inkwell.llm.batches import map_columns

#: The sum below which a run of lines inside the content region is furniture.
ISLAND = -2.5
#: The sum above which a run of lines outside of it is a passage of the record, cut off by furniture.
PASSAGE = 3.0
#: The score from which a line below a list's heading is the record's again.
LISTED = 5.0
#: The score below which a line is no beginning of the sentence that goes on in the next.
CLEAR = -3.5


def best_run(scores: list[float]) -> tuple[int, int]:
    """The run [begin, end) with the largest sum; of equal ones the first; empty if nothing scores above 0."""
    best, span, total, begin = 0.0, (0, 0), 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, begin = 0.0, i
        total += s
        if total > best:
            best, span = total, (begin, i + 1)
    return span


def islands(scores: list[float], least: float) -> list[tuple[int, int]]:
    """The disjoint runs [begin, end) with the smallest sums, each below ``least``, found from left to right.

    A run is closed when the sum has risen by more than the run is deep: what follows cannot belong to it.
    """
    out, total, low, begin, end = [], 0.0, 0.0, 0, 0
    for i, s in enumerate([*scores, float("inf")]):
        if total + s >= 0 or total + s > low - least:
            if low < least:
                out.append((begin, end))
            total, low, begin = 0.0, 0.0, i + 1
            if s < 0 and s != float("inf"):
                total, low, begin, end = s, s, i, i + 1
            continue
        if total == 0.0:
            begin = i
        total += s
        if total < low:
            low, end = total, i + 1
    return out


class LineJudge:
    """Scores of lines, remembered up to a bound."""

    BOUND = 100_000

    def __init__(self):
        self.memo: dict[str, float] = {}

    def __call__(self, line: str) -> float:
        known = self.memo.get(line)
        if known is None:
            known = lines.score(line)
            if len(line) <= lines.LONG:
                if len(self.memo) >= self.BOUND:
                    self.memo.clear()
                self.memo[line] = known
        return known


def line_scores(rows: list[str], judge: LineJudge) -> list[float]:
    """The scores of a page's lines, sentences broken over lines taken together."""
    scores = [judge(r) for r in rows]
    listed = False
    for i, row in enumerate(rows):
        # short lines without the end of a sentence below the heading of a list of other records belong to it
        bare = row.strip()
        head = bare.lower() in lines.list_heads()
        listed = head or listed and len(bare) <= lines.LONG and bool(bare) and not lines.ENDS.search(bare) and scores[i] < LISTED
        if listed:
            scores[i] = min(scores[i], -1.5)
    for i in range(1, len(rows)):
        before, here = rows[i - 1].rstrip(), rows[i]
        after = rows[i + 1] if i + 1 < len(rows) else ""
        runs_on = here[:1].islower() or here[:1].isdigit() or after[:1].islower() or after[:1] in (",", ".", ";", ":")
        if scores[i] < 0 < scores[i - 1] and before and not lines.ENDS.search(before) and runs_on:
            scores[i] = 0.5
    for i in range(len(rows) - 2, -1, -1):
        if CLEAR < scores[i] < 0 < scores[i + 1] and rows[i].strip() and rows[i + 1][:1].islower() and not lines.ENDS.search(rows[i].rstrip()):
            scores[i] = 0.5
    return scores


def furniture(text: str, judge: LineJudge) -> list[int]:
    """Numbers (from 1) of the furniture lines of ``text``."""
    rows = text.split("\n")
    scores = line_scores(rows, judge)
    begin, end = best_run(scores)
    inside = {i for a, b in islands(scores[begin:end], ISLAND) for i in range(begin + a, begin + b)}
    outside = {*range(begin), *range(end, len(rows))}
    for lo, hi in ((0, begin), (end, len(rows))):
        outside -= {i for a, b in islands([-s for s in scores[lo:hi]], -PASSAGE) for i in range(lo + a, lo + b)}
    return [i + 1 for i in sorted(inside | outside) if rows[i].strip()]


def furniture_lines(texts: DataFrame) -> DataFrame:
    """Of ``texts(tbl, id, text)``: tbl, row_id, line_no of each furniture line."""

    def kernel(c: dict, judge: LineJudge) -> dict:
        out: dict[str, list] = {"tbl": [], "row_id": [], "line_no": []}
        for tbl, i, text in zip(c["tbl"], c["id"], c["text"]):
            if text:
                found = furniture(text, judge)
                out["tbl"].extend([tbl] * len(found))
                out["row_id"].extend([i] * len(found))
                out["line_no"].extend(found)
        return out

    return map_columns(texts.select("tbl", "id", "text"), kernel, "tbl string, row_id bigint, line_no bigint", LineJudge)


def main_text(texts: DataFrame) -> DataFrame:
    """Of ``texts(tbl, id, text)``: tbl, row_id, main (the text without furniture lines), removed (their number)."""

    def kernel(c: dict, judge: LineJudge) -> dict:
        main, removed = [], []
        for text in c["text"]:
            found = set(furniture(text, judge)) if text else set()
            main.append("\n".join(r for n, r in enumerate(text.split("\n"), 1) if n not in found) if text else text)
            removed.append(len(found))
        return {"tbl": c["tbl"], "row_id": c["id"], "main": main, "removed": removed}

    return map_columns(texts.select("tbl", "id", "text"), kernel, "tbl string, row_id bigint, main string, removed bigint", LineJudge)
