"""The pN_ queries over the data directory's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.llm import boilerplate, contamination, names, near_duplicates, offensive, packing, splitting, token_budget, transcripts, truncation
from inkwell.llm.batches import tokenizer_path
from inkwell.sources.tables import table


def _texts(spark: SparkSession, sf: str) -> DataFrame:
    """Page texts and passages alike: tbl, id, text."""
    flat = table(spark, sf, "flat_documents").select(F.lit("flat_documents").alias("tbl"), F.col("flat_id").alias("id"), F.col("full_text").alias("text"))
    chunks = table(spark, sf, "chunks").select(F.lit("chunks").alias("tbl"), F.col("chunk_row").alias("id"), F.col("body").alias("text"))
    return flat.unionByName(chunks)


# 1 -------------------------------------------------------------------------------------------------------------------
def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    members, pairs = near_duplicates.similar_pairs(_texts(spark, sf), width=3, similarity=0.6, min_words=30)
    return near_duplicates.expanded(members, pairs)


def p1_groups(spark: SparkSession, sf: str) -> DataFrame:
    members, pairs = near_duplicates.similar_pairs(_texts(spark, sf), width=5, similarity=0.8, min_words=1)
    return near_duplicates.groups(members, pairs)


# 2 -------------------------------------------------------------------------------------------------------------------
def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return boilerplate.furniture_lines(_texts(spark, sf))


def p2_main_text(spark: SparkSession, sf: str) -> DataFrame:
    return boilerplate.main_text(_texts(spark, sf))


# 3 -------------------------------------------------------------------------------------------------------------------
def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    turns = transcripts.turns_of(table(spark, sf, "session_documents"))
    chunks = table(spark, sf, "chunks").where(transcripts.unclean_speaker(F.col("speaker")))
    return (
        transcripts.dirt(turns)
        .select(F.lit("session_documents").alias("tbl"), "row_id", "turn_no", "kind")
        .unionByName(
            chunks.select(
                F.lit("chunks").alias("tbl"), F.col("chunk_row").alias("row_id"), F.lit(0).cast("bigint").alias("turn_no"), F.lit("label").alias("kind")
            )
        )
    )


def p3_turns(spark: SparkSession, sf: str) -> DataFrame:
    return transcripts.clean_turns(transcripts.turns_of(table(spark, sf, "session_documents")))


# 4 -------------------------------------------------------------------------------------------------------------------
def _cut(spark: SparkSession, sf: str) -> DataFrame:
    flat = table(spark, sf, "flat_documents").select(
        F.lit("flat_documents").alias("tbl"), F.col("flat_id").alias("id"), F.col("full_text").alias("text"), "url", "collection"
    )
    chunks = table(spark, sf, "chunks").select(
        F.lit("chunks").alias("tbl"), F.col("chunk_row").alias("id"), F.col("body").alias("text"), F.col("source_url").alias("url"), "collection"
    )
    return truncation.cut_rows(flat.unionByName(chunks))


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return _cut(spark, sf).where("cut").select("tbl", "row_id")


def p4_rates(spark: SparkSession, sf: str) -> DataFrame:
    return truncation.rates(_cut(spark, sf))


# 5 -------------------------------------------------------------------------------------------------------------------
def _census(spark: SparkSession, sf: str) -> DataFrame:
    null = F.lit(None).cast("string")
    chunks = token_budget.census(
        table(spark, sf, "chunks"), "chunks", "chunk_row", "text", F.col("token_count"), F.col("collection"), F.col("lang"), F.col("source_url"), null
    )
    flat = token_budget.census(
        table(spark, sf, "flat_documents"), "flat_documents", "flat_id", "full_text", F.col("word_count"), F.col("collection"), F.col("lang"), F.col("url"), F.col("doc_type")
    )
    return chunks.unionByName(flat)


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    counted = F.when(F.col("tbl") == "chunks", F.col("offline_tokens")).otherwise(F.col("pieces"))
    return _census(spark, sf).where(~F.col("stated").eqNullSafe(counted)).select("tbl", "row_id")


def p5_budget(spark: SparkSession, sf: str) -> DataFrame:
    return token_budget.budget(_census(spark, sf))


# 6 -------------------------------------------------------------------------------------------------------------------
def _pieces(spark: SparkSession, sf: str) -> DataFrame:
    limits = table(spark, sf, "size_limits").select("slice_name", "max_tokens", "overlap_tokens")
    flat = table(spark, sf, "flat_documents").select(
        F.lit("flat_documents").alias("tbl"), F.col("flat_id").alias("row_id"), F.lit(0).cast("bigint").alias("turn_no"), F.col("full_text").alias("text"), F.col("collection").alias("slice_name")
    )
    turns = table(spark, sf, "session_documents").select(
        F.lit("session_documents").alias("tbl"), F.col("session_id").alias("row_id"), F.posexplode("turns").alias("at", "turn")
    ).select("tbl", "row_id", (F.col("at") + 1).cast("bigint").alias("turn_no"), F.col("turn.text").alias("text"), F.lit("sessions").alias("slice_name"))
    items = flat.unionByName(turns).join(limits, "slice_name", "left")
    return splitting.split_items(items, ["tbl", "row_id", "turn_no"])


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return _pieces(spark, sf).where("n_pieces > 1 and piece_no = 1").select("tbl", "row_id", "turn_no")


def p6_pieces(spark: SparkSession, sf: str) -> DataFrame:
    return _pieces(spark, sf)


# 7 -------------------------------------------------------------------------------------------------------------------
def _names(spark: SparkSession, sf: str) -> DataFrame:
    sessions = table(spark, sf, "session_documents").select(F.explode("speakers").alias("name"))
    both = sessions.unionByName(table(spark, sf, "chunks").select(F.col("speaker").alias("name")))
    return names.entities(both, "name")


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    return names.variant_pairs(_names(spark, sf))


def p7_entities(spark: SparkSession, sf: str) -> DataFrame:
    return _names(spark, sf)


# 8 -------------------------------------------------------------------------------------------------------------------
def _packed(spark: SparkSession, sf: str, vocabulary: str | None) -> DataFrame:
    row = table(spark, sf, "size_limits").where("slice_name = 'container'").select("max_tokens").first()
    if row is None:
        raise ValueError("size_limits has no row for container")
    return packing.pack(table(spark, sf, "documents").select("doc_id", "text"), int(row[0]), vocabulary=vocabulary)


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    # its definition counts tokens offline
    return _packed(spark, sf, None).where("n_pieces > 1").select("doc_id").distinct()


def p8_containers(spark: SparkSession, sf: str) -> DataFrame:
    return _packed(spark, sf, tokenizer_path(token_budget.VOCABULARY))


# 9 -------------------------------------------------------------------------------------------------------------------
def _leaks(spark: SparkSession, sf: str) -> DataFrame:
    return contamination.hits(table(spark, sf, "documents"), table(spark, sf, "eval_passages"))


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    return contamination.leaked(_leaks(spark, sf))


def p9_cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return contamination.cleaned(table(spark, sf, "documents"), _leaks(spark, sf))


# 10 ------------------------------------------------------------------------------------------------------------------
def _scored(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents")
    return offensive.scores(documents, offensive.train(documents, table(spark, sf, "review_labels")))


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    return _scored(spark, sf).where(F.col("score") >= offensive.THRESHOLD).select("doc_id")


def p10_rates(spark: SparkSession, sf: str) -> DataFrame:
    return offensive.rates(_scored(spark, sf))


def queries() -> dict:
    """All queries of this subpackage by name."""
    return {k: v for k, v in globals().items() if k[:1] == "p" and k[1:2].isdigit()}
