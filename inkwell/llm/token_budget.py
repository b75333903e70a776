"""Problem 5: how many tokens each text has, counted afresh, and the totals by slice.

``census`` gives one row per text: the stated count, the counts made here (offline count of the data model, white-space
pieces, tokens of a public byte-pair vocabulary by the automaton of ``bpe``). ``budget`` sums them over a cube.

Nulls: a null text has 0 pieces and 0 vocabulary tokens and a null offline count; a null slice column is a value of its
own, told from a cube's total by ``grouping``. Repeated rows stay; ``usable_tokens`` counts equal texts once, in the
slice of the smallest row id. Empty tables give no rows (the cube's grand total aside).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.functions.text import host_of, offline_tokens
from inkwell.llm.batches import map_columns, tokenizer_path
from inkwell.llm.bpe import counter

VOCABULARY = "byte_bpe_50k.tiktoken"
SLICES = ("tbl", "collection", "lang", "host", "doc_type")


def census(
    df: DataFrame,
    tbl: str,
    row_id: str,
    text: str,
    stated: Column,
    collection: Column,
    lang: Column,
    url: Column,
    doc_type: Column,
    vocabulary: str | None = None,
) -> DataFrame:
    """One row per row of ``df``; columns tbl, row_id, the slices, digest, stated, offline_tokens, pieces, bpe_tokens."""
    path = vocabulary or tokenizer_path(VOCABULARY)
    base = df.select(
        F.col(row_id).cast("bigint").alias("row_id"),
        F.col(text).alias("text"),
        collection.cast("string").alias("collection"),
        lang.cast("string").alias("lang"),
        host_of(url).alias("host"),
        doc_type.cast("string").alias("doc_type"),
        stated.cast("bigint").alias("stated"),
        offline_tokens(F.col(text)).cast("bigint").alias("offline_tokens"),
        F.md5(F.col(text)).alias("digest"),
    )
    kept = ["row_id", "collection", "lang", "host", "doc_type", "stated", "offline_tokens", "digest"]

    def kernel(c: dict, bpe) -> dict:
        out = {k: c[k] for k in kept}
        out["pieces"] = [len(t.split()) if t else 0 for t in c["text"]]
        out["bpe_tokens"] = [bpe.count(t) for t in c["text"]]
        return out

    schema = (
        "row_id bigint, collection string, lang string, host string, doc_type string, stated bigint, "
        "offline_tokens bigint, digest string, pieces bigint, bpe_tokens bigint"
    )
    return map_columns(base, kernel, schema, lambda: counter(path)).select(F.lit(tbl).alias("tbl"), "*")


def budget(rows: DataFrame) -> DataFrame:
    """Totals of a census over the cube of its slices: texts, tokens, and usable_tokens (equal texts counted once)."""
    copies = rows.groupBy("tbl", "digest").agg(F.min(F.struct("row_id", *SLICES[1:], "bpe_tokens")).alias("first"))
    usable = copies.select("tbl", *[F.col(f"first.{c}").alias(c) for c in SLICES[1:]], F.col("first.bpe_tokens").alias("u"))
    slices = (
        rows.groupBy(*SLICES)
        .agg(F.count(F.lit(1)).alias("n"), F.sum("bpe_tokens").alias("t"), F.sum("offline_tokens").alias("o"))
        .withColumn("u", F.lit(0).cast("bigint"))
        .unionByName(
            usable.groupBy(*SLICES).agg(F.sum("u").alias("u")).withColumns({k: F.lit(0).cast("bigint") for k in ("n", "t", "o")})
        )
    )
    return slices.cube(*SLICES).agg(
        F.grouping_id().cast("bigint").alias("grouping"),
        F.sum("n").alias("texts"),
        F.sum("t").alias("tokens"),
        F.sum("o").alias("offline_tokens"),
        F.sum("u").alias("usable_tokens"),
    )
