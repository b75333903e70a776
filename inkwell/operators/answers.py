"""Context blocks for a question, the check of an answer's citations, and the cache of answers.

Nulls: a null answer is an empty one; null parts of a source are written as unknown. A question without sources has an
empty context.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHARS_A_TOKEN = 4
# How citations are written, and how an answer says that the sources are silent.
_NUMBER = r"(?i)\[SOURCE\s+(\d+)\]"
_SPELLINGS = (r"(?i)\[\[SOURCE\s+(\d+)\]\]?", r"(?i)\(SOURCE\s+(\d+)[^)]*\)", r"(?i)\bSOURCE\s+(\d+)\]", r"(?i)\bSOURCE\s+(\d+)(?=[,.\s])", r"(?i)\[\[SOURCE\s+(\d+)\]")
_SILENT = r"(?i)^(?:The provided sources|According to the provided sources)"


def source_block(n: Column, collection: Column, date: Column, speaker: Column, page: Column, slug: Column, body: Column) -> Column:
    """One source as header and body; page 0 counts as unknown."""
    known = lambda c, other: F.coalesce(F.when(c.cast("string") != "", c.cast("string")), F.lit(other))
    head = F.concat(
        F.lit("[SOURCE "), n.cast("string"), F.lit(" | "), known(collection, "unknown"), F.lit(" | "), known(date, "date unknown"), F.lit(" | speaker: "),
        known(speaker, "-"), F.lit(" | page: "), F.coalesce(F.when(page != 0, page.cast("string")), F.lit("?")), F.lit(" | slug: "), known(slug, ""), F.lit("]"),
    )
    return F.struct(head.alias("head"), F.trim(F.coalesce(body, F.lit(""))).alias("body"))


def context_block(blocks: Column, max_tokens: int) -> Column:
    """Ordered source blocks joined within a budget of characters; the last one that fits in part is marked as cut."""
    budget = max_tokens * CHARS_A_TOKEN
    start = F.struct(F.lit("").alias("text"), F.lit(0).alias("used"), F.lit(False).alias("full"))

    def add(acc, b):
        room = F.lit(budget) - acc["used"] - F.length(b["head"]) - 1
        over = acc["full"] | (room <= 0)
        body = F.when(F.length(b["body"]) > room, F.concat(F.left(b["body"], room), F.lit("...  [truncated]"))).otherwise(b["body"])
        block = F.concat(b["head"], F.lit("\n"), body)
        text = F.when(acc["used"] == 0, block).otherwise(F.concat(acc["text"], F.lit("\n\n"), block))
        return F.struct(
            F.when(over, acc["text"]).otherwise(text).alias("text"),
            F.when(over, acc["used"]).otherwise(acc["used"] + F.length(block) + 2).cast("int").alias("used"),
            over.alias("full"),
        )

    return F.aggregate(blocks, start, add, lambda a: a["text"])


def user_message(question: Column, context: Column) -> Column:
    """The message to a generator."""
    return F.concat(F.lit("SOURCES:\n\n"), context, F.lit("\n\n---\n\nQUESTION: "), question)


def normalised_citations(answer: Column) -> Column:
    """All spellings of a citation as [SOURCE n]; the order of the rewrites matters."""
    a = F.coalesce(answer, F.lit(""))
    for pattern in _SPELLINGS:
        a = F.regexp_replace(a, pattern, "[SOURCE $1]")
    return a


def _one_of_each(line: Column) -> Column:
    """A line in which of equal citations only the last stays."""
    refs = F.regexp_extract_all(line, F.lit(r"(?i)\[SOURCE\s+\d+\]"), F.lit(0))
    start = F.struct(F.array().cast("array<string>").alias("seen"), line.alias("text"))

    def step(acc, ref):
        again = F.array_contains(acc["seen"], ref)
        at = F.position(ref, acc["text"])
        cut = F.concat(F.left(acc["text"], at - 1), F.substr(acc["text"], at + F.length(ref)))
        return F.struct(F.when(again, acc["seen"]).otherwise(F.concat(acc["seen"], F.array(ref))).alias("seen"), F.when(again, cut).otherwise(acc["text"]).alias("text"))

    return F.aggregate(refs, start, step, lambda a: a["text"])


def verified(answers: DataFrame, *kept: str) -> DataFrame:
    """Of ``answers(id, answer, num_sources)``: the verified text and its report: id, the columns ``kept``, verified, cited,
    hallucinated, uncited_sources, uncited_paragraphs (previews of 120), clean."""
    n = answers.withColumn("a", normalised_citations(F.col("answer"))).withColumn(
        "all_cited", F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all("a", F.lit(_NUMBER), F.lit(1)), lambda x: x.cast("bigint"))))
    )
    valid = F.when(F.col("num_sources") > 0, F.sequence(F.lit(1).cast("bigint"), F.col("num_sources").cast("bigint"))).otherwise(F.array().cast("array<bigint>"))
    n = n.withColumn("valid", valid).withColumn("hallucinated", F.array_except("all_cited", "valid"))
    stripped = F.aggregate("hallucinated", F.col("a"), lambda t, x: F.regexp_replace(t, F.concat(F.lit(r"(?i)\[SOURCE\s+"), x.cast("string"), F.lit(r"\]")), F.lit("")))
    n = n.withColumn("s", F.when(F.size("hallucinated") > 0, F.trim(F.regexp_replace(stripped, " {2,}", " "))).otherwise(F.col("a")))
    n = n.withColumn("verified", F.array_join(F.transform(F.split("s", "\n"), _one_of_each), "\n"))
    body = F.split("verified", "(?i)Sources cited:")[0]
    paragraphs = F.filter(F.transform(F.split(body, r"\n\s*\n"), lambda p: F.trim(p)), lambda p: p != "")
    bare = F.filter(
        paragraphs,
        lambda p: (F.length(p) > 40) & ~p.rlike(_NUMBER) & ~p.rlike(_SILENT),
    )
    n = n.withColumn("uncited_paragraphs", F.transform(bare, lambda p: F.when(F.length(p) > 120, F.concat(F.left(p, F.lit(120)), F.lit("..."))).otherwise(p)))
    return n.select(
        "id", *kept, "verified", F.array_sort(F.array_intersect("all_cited", "valid")).alias("cited"), F.array_sort("hallucinated").alias("hallucinated"),
        F.array_sort(F.array_except("valid", "all_cited")).alias("uncited_sources"), "uncited_paragraphs",
        ((F.size("hallucinated") == 0) & (F.size("uncited_paragraphs") == 0)).alias("clean"),
    )


def cache_key(v: Column) -> Column:
    """The first eight dimensions at four decimals."""
    return F.array_join(F.transform(F.slice(v, 1, 8), lambda x: F.format_string("%.4f", x.cast("double"))), ",")
