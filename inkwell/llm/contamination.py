"""Problem 9: passages of held-out items inside the training documents.

The word n-grams of all items are a broadcast set of hashes, held as a table of bits whose size is bounded. Every n-gram of
every document is looked up in it; the hits meet the items' n-grams in a join on the words themselves, which verifies them,
and hits in a row are put together to spans.

Nulls: null and empty texts, and texts or items of less than ``n`` words, have no n-gram and give no row. Repeated ids are
put together. Empty tables give no rows.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkwell.llm.batches import map_columns
from inkwell.llm.words import WORD, WordHashes, hashed_words, windows, words

WORDS_IN_A_ROW = 12
#: Least and most bits (powers of two) of the table of hashes, and bits an n-gram between these: at most 16 MB are sent.
#: One n-gram in some thousands is a false hit, which the join drops, up to 30 000 of the items; one in 16 at 8 million.
LEAST_BITS, MOST_BITS, BITS_A_GRAM = 15, 27, 4096


def _item_grams(items: DataFrame, n: int) -> DataFrame:
    """Distinct n-grams of the items: item_id, hash, gram."""

    def kernel(c: dict, memo: WordHashes) -> dict:
        h, starts = hashed_words(c["text"], memo)
        g, owner, pos = windows(h, starts, n)
        said = [words(t) for t in c["text"]]
        return {
            "item_id": [c["item_id"][o] for o in owner.tolist()], "hash": g.view(np.int64),
            "gram": [" ".join(said[o][p : p + n]) for o, p in zip(owner.tolist(), pos.tolist())],
        }

    return map_columns(items, kernel, "item_id bigint, hash bigint, gram string", WordHashes).distinct()


def _bit_table(grams: DataFrame) -> tuple[int, np.ndarray]:
    """The number of hash bits looked at, and the table: whether some n-gram has these bits."""
    total = grams.agg(F.approx_count_distinct("hash")).first()[0]
    bits = min(MOST_BITS, max(LEAST_BITS, int(max(1, total) * BITS_A_GRAM - 1).bit_length()))
    place = F.shiftrightunsigned("hash", 64 - bits) + 1  # buckets and their bits count from 1
    parts = grams.select(place.alias("place")).groupBy(F.bitmap_bucket_number("place").alias("no")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("b"))
    table = np.zeros((1 << bits) // 8, dtype=np.uint8)
    for r in parts.collect():  # at most 2**27 bits
        at = (r.no - 1) * 4096
        part = np.frombuffer(bytes(r.b), dtype=np.uint8)
        table[at : at + 4096] |= part[: len(table) - at]
    return bits, table


def hits(documents: DataFrame, items: DataFrame, n: int = WORDS_IN_A_ROW) -> DataFrame:
    """Maximal runs of words that a document shares with an item: doc_id, item_id, begin, end (characters of the text)."""
    documents = documents.select(F.col("doc_id").cast("bigint"), "text").where(F.col("text").isNotNull())
    grams = _item_grams(items.select(F.col("item_id").cast("bigint"), "text").where(F.col("text").isNotNull()), n)
    bits, table = _bit_table(grams)
    shared = documents.sparkSession.sparkContext.broadcast(table)  # at most 16 MB

    def kernel(c: dict, state: tuple) -> dict:
        memo, table = state
        out: dict[str, list] = {k: [] for k in ("doc_id", "copy", "hash", "gram", "pos", "begin", "end")}
        h, starts = hashed_words(c["text"], memo)
        g, owner, pos = windows(h, starts, n)
        place = (g >> np.uint64(64 - bits)).astype(np.int64)
        found = np.flatnonzero(table[place >> 3] >> (place & 7).astype(np.uint8) & 1)
        seen, spans, said = -1, [], []
        for o, p, x in zip(owner[found].tolist(), pos[found].tolist(), g[found].view(np.int64).tolist()):
            if o != seen:
                seen, text = o, c["text"][o]
                low = text.lower()
                # lower case may be longer; then places are sought in the text itself
                spans = [(m.start(), m.end()) for m in (WORD if len(low) == len(text) else re.compile(r"[^\W_]+")).finditer(low if len(low) == len(text) else text)]
                said = words(text)
            last = len(spans) - 1
            for k, v in zip(out, (c["doc_id"][o], c["copy"][o], x, " ".join(said[p : p + n]), p, spans[min(p, last)][0], spans[min(p + n - 1, last)][1])):
                out[k].append(v)
        return out

    schema = "doc_id bigint, copy bigint, hash bigint, gram string, pos bigint, begin bigint, `end` bigint"
    found = map_columns(documents.select("doc_id", "text", F.xxhash64("text").alias("copy")), kernel, schema, lambda: (WordHashes(), shared.value))
    both = found.join(grams, ["hash", "gram"])
    # runs of one text; their number is bounded by its length
    w = Window.partitionBy("doc_id", "copy", "item_id").orderBy("pos")
    gap = F.sum(F.when(F.col("pos") <= F.col("before") + n, 0).otherwise(1))
    runs = both.withColumn("before", F.lag("pos").over(w)).withColumn("run", gap.over(w))
    return runs.groupBy("doc_id", "copy", "item_id", "run").agg(F.min("begin").alias("begin"), F.max("end").alias("end")).select("doc_id", "item_id", "begin", "end")


def leaked(found: DataFrame) -> DataFrame:
    """A row per document and item: doc_id, item_id."""
    return found.select("doc_id", "item_id").distinct()


def cleaned(documents: DataFrame, found: DataFrame) -> DataFrame:
    """The documents with every leaked span cut out: doc_id, text, removed (characters), items."""
    spans = found.groupBy("doc_id").agg(
        F.sort_array(F.collect_set(F.struct("begin", "end"))).alias("spans"), F.array_sort(F.collect_set("item_id")).alias("items")
    )
    start = F.struct(F.lit("").alias("kept"), F.lit(0).cast("bigint").alias("at"))

    def cut(acc, x):
        take = F.greatest(F.lit(0).cast("bigint"), x["begin"] - acc["at"])
        kept = F.concat(acc["kept"], F.substr(F.col("text"), (acc["at"] + 1).cast("int"), take.cast("int")))
        return F.struct(kept.alias("kept"), F.greatest(acc["at"], x["end"]).alias("at"))

    rest = F.aggregate(F.col("spans"), start, cut, lambda a: F.concat(a["kept"], F.substr(F.col("text"), (a["at"] + 1).cast("int"))))
    joined = documents.select(F.col("doc_id").cast("bigint"), "text").join(spans, "doc_id", "left")
    clean = F.when(F.col("spans").isNull(), F.col("text")).otherwise(rest)
    return joined.select(
        "doc_id",
        clean.alias("text"),
        (F.length("text") - F.length(clean)).cast("bigint").alias("removed"),
        F.coalesce("items", F.array().cast("array<bigint>")).alias("items"),
    )
