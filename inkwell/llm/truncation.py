"""Problem 4: texts cut by a length limit or broken off in transfer.

Per source (host, collection, both) the distribution of lengths, in characters and in bytes, is tested for spikes: a
length at which many more different texts end than at the lengths around it is a limit, and values of that length were
cut. Elsewhere a text is cut when it ends within a sentence, or within a line that is known by its form.

Nulls: a null or blank text is not cut; a null host or collection is a source of its own. Equal texts count once for a
spike. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkwell.functions.text import host_of
from inkwell.llm import lines
from inkwell.llm.batches import map_columns
from inkwell.sources.shared import materialise

#: Lengths on either side to which a length is compared, the fewest different texts of a spike, and its least height.
AROUND, LEAST, TIMES = 40, 5, 4.0
#: Characters of the end that are looked at; a line longer than that is a sentence.
TAIL = 400


def ends_cut(tail: str) -> bool:
    """Whether a text that ends in ``tail`` breaks off: within a sentence, or within a known line."""
    rows = tail.rstrip().split("\n")
    last = rows[-1].strip()
    if not last:
        return False
    if lines.is_record_form(last) or lines.is_furniture_form(last):
        return False
    begins, record = lines.begins_furniture(last) if len(last) <= lines.LONG else (False, False)
    if lines.ENDS.search(last):
        return bool(lines.OPEN_ABBREVIATION.search(last))
    if last[-1] in ")]}>*\"”»" or last.endswith("--"):
        return not any(p in last for p in ".?!") and not last.startswith("(")
    if begins or record:
        return True
    words = last.split()
    # a line of capitals is a heading when it is not within a sentence of the line before
    if last.isupper() and len(words) <= 7 and lines.is_record_form(last.title()):
        return False
    return True


def _lengths(texts: DataFrame) -> DataFrame:
    return texts.select(
        "tbl", "id", "collection", host_of(F.col("url")).alias("host"), F.length("text").alias("chars"), F.octet_length("text").alias("bytes"),
        F.xxhash64("text").alias("digest"), F.right("text", F.lit(TAIL)).alias("tail"),
    )


def spikes(sized: DataFrame) -> DataFrame:
    """Lengths at which a source cuts: tbl, host, collection (null where any), measure, length, n, expected."""
    distinct = sized.groupBy("tbl", "host", "collection", "chars", "bytes", "digest").agg(F.lit(1).alias("one"))
    counted = distinct.groupBy(
        "tbl", F.coalesce("host", F.lit("")).alias("host"), F.coalesce("collection", F.lit("")).alias("collection"), "chars", "bytes"
    ).agg(F.sum("one").alias("n"))
    counted = materialise(counted)
    fine = materialise(_tested(counted, ["host", "collection"]))
    # what a host's own limit in a collection explains is no limit of the host or the collection
    rest = counted
    for measure in ("chars", "bytes"):
        explained = fine.where(F.col("measure") == measure).select("tbl", "host", "collection", F.col("length").alias(measure))
        rest = rest.join(explained, ["tbl", "host", "collection", measure], "left_anti")
    return fine.unionByName(_tested(rest, ["host"])).unionByName(_tested(rest, ["collection"]))


def _tested(counted: DataFrame, by: list[str]) -> DataFrame:
    """The spikes of the sources that ``by`` tells apart; the other column is ``*``.

    Bytes and characters of plain text agree, so the measure with the higher spike of a source comes first; of the other
    one a spike counts only if it stands without the rows at the first one's spikes.
    """
    high = _spiky(counted, by)
    of_source = Window.partitionBy("tbl", "host", "collection")
    best = F.max_by("measure", F.struct("n", "measure")).over(of_source)
    first = materialise(high.withColumn("best", best).where("measure = best").drop("best"))
    rest = counted
    keys = [c for c in ("host", "collection") if c in by]
    for measure in ("chars", "bytes"):
        explained = first.where(F.col("measure") == measure).select("tbl", *keys, F.col("length").alias(measure))
        rest = rest.join(explained, ["tbl", *keys, measure], "left_anti")
    measured = first.select("tbl", "host", "collection", "measure").distinct()
    second = _spiky(rest, by).join(measured, ["tbl", "host", "collection", "measure"], "left_anti")
    return first.unionByName(second.select(*first.columns))


def _spiky(counted: DataFrame, by: list[str]) -> DataFrame:
    """Lengths at which many more texts end than at those around: tbl, host, collection, measure, length, n, expected."""
    source = [F.col(c) if c in by else F.lit("*").alias(c) for c in ("host", "collection")]
    parts = [counted.select("tbl", *source, F.lit(m).alias("measure"), F.col(m).alias("length"), "n") for m in ("chars", "bytes")]
    hist = parts[0].unionByName(parts[1]).groupBy("tbl", "host", "collection", "measure", "length").agg(F.sum("n").alias("n"))
    w = Window.partitionBy("tbl", "host", "collection", "measure").orderBy("length")
    below = F.coalesce(F.sum("n").over(w.rangeBetween(-AROUND, -1)), F.lit(0)) / AROUND
    above = F.coalesce(F.sum("n").over(w.rangeBetween(1, AROUND)), F.lit(0)) / AROUND
    tested = hist.withColumn("expected", F.greatest(below, (below + above) / 2))
    high = (F.col("n") >= LEAST) & (F.col("n") >= TIMES * F.col("expected")) & (F.col("n") >= F.col("expected") + 6 * F.sqrt("expected") + 4)
    return tested.where(high)


def cut_rows(texts: DataFrame) -> DataFrame:
    """Of ``texts(tbl, id, text, url, collection)``: tbl, row_id, host, collection, at_limit, broken, cut."""
    sized = _lengths(texts.where(F.col("text").isNotNull()))
    found = spikes(sized)
    limits = found.select(
        "tbl", "measure", F.col("host").alias("l_host"), F.col("collection").alias("l_coll"), F.col("length").alias("l_length"), (F.col("expected") / F.col("n")).alias("chance")
    )

    def kernel(c: dict, _) -> dict:
        out = {k: c[k] for k in ("tbl", "id", "host", "collection", "chars", "bytes")}
        out["broken"] = [bool(t and t.strip()) and ends_cut(t) for t in c["tail"]]
        return out

    judged = map_columns(
        sized.drop("digest"), kernel, "tbl string, id bigint, host string, collection string, chars int, bytes int, broken boolean"
    )
    # a row has six chances to be at a limit: three sources, two measures
    keys = F.array(
        *[
            F.struct(F.lit(m).alias("measure"), F.col(m).alias("l_length"), h.alias("l_host"), c.alias("l_coll"))
            for m in ("chars", "bytes")
            for h, c in (
                (F.coalesce("host", F.lit("")), F.lit("*")),
                (F.lit("*"), F.coalesce("collection", F.lit(""))),
                (F.coalesce("host", F.lit("")), F.coalesce("collection", F.lit(""))),
            )
        ]
    )
    hits = (
        judged.select("tbl", "id", F.explode(keys).alias("k"))
        .select("tbl", "id", "k.*")
        .join(limits, ["tbl", "measure", "l_length", "l_host", "l_coll"])
        .groupBy("tbl", "id")
        .agg(F.min("chance").alias("chance"))
    )
    both = judged.join(hits, ["tbl", "id"], "left")
    # a row at a spike is there by chance with the share of rows expected at that length; a tenth is the most that is taken
    at = F.col("chance").isNotNull()
    return both.select(
        "tbl", F.col("id").alias("row_id"), "host", "collection", at.alias("at_limit"), "broken", (F.col("broken") | (at & (F.col("chance") <= 0.1))).alias("cut")
    )


def rates(rows: DataFrame) -> DataFrame:
    """Per table, host and collection: texts, cut ones, at a limit, and their share."""
    return rows.groupBy("tbl", "host", "collection").agg(
        F.count(F.lit(1)).alias("texts"),
        F.count_if("cut").alias("cut"),
        F.count_if("at_limit").alias("at_limit"),
        F.round(F.count_if("cut") / F.count(F.lit(1)), 6).alias("share"),
    )
