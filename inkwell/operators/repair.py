"""Chunk repair and resume: what is done, what is a duplicate, what has no source, and metadata patches.

Nulls: a null key matches nothing; a group whose first url is null is no duplicate. Repeated rows stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.functions.text import base_url, context_header, offline_tokens
from inkwell.operators.chunking import split_documents


def not_done(work: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows of ``work`` whose key is not among those of ``done``; rows without a key are kept."""
    return work.join(done.select(key).distinct(), key, "left_anti")


def session_duplicates(chunks: DataFrame, sessions: DataFrame, pattern: str) -> DataFrame:
    """Slugs whose first chunk's url has a fragment, a date-shaped base and a session of that base: slug, url, n."""
    groups = chunks.groupBy("slug").agg(F.min_by("source_url", "chunk_row").alias("url"), F.count(F.lit(1)).alias("n"))
    marked = groups.where(F.contains("url", F.lit("#"))).withColumn("base", base_url(F.col("url")))
    return marked.where(F.col("base").rlike(pattern)).join(sessions.select(base_url(F.col("url")).alias("base")).distinct(), "base", "left_semi")


def with_source(chunks: DataFrame, documents: DataFrame) -> DataFrame:
    """Per slug the source document of its base url, null for an orphan, which is kept: slug, n, base, doc_url."""
    groups = chunks.groupBy("slug", base_url(F.col("source_url")).alias("base")).agg(F.count(F.lit(1)).alias("n"))
    docs = documents.select(base_url(F.col("url")).alias("base"), F.col("url").alias("doc_url")).groupBy("base").agg(F.min("doc_url").alias("doc_url"))
    return groups.join(docs, "base", "left")


def patched(chunks: DataFrame, date: Column, speaker: Column) -> DataFrame:
    """Chunks with a new date and speaker where given, and header, text and token count made anew."""
    fresh = chunks.withColumns({"date_iso": F.coalesce(date, "date_iso"), "speaker": F.coalesce(speaker, "speaker")})
    header = context_header(*[F.col(c) for c in ("date_iso", "slug", "speaker", "collection", "page_number")])
    return fresh.withColumn("text", F.concat(header, F.lit("\n"), "body")).withColumn("token_count", offline_tokens(F.col("text")))


def rewritten(chunks: DataFrame, actions: DataFrame, documents: DataFrame, date: Column, speaker: Column) -> DataFrame:
    """The passage table after repair: chunk_id, slug, source_url, collection, date_iso, speaker, page_number, chunk_index,
    token_count, text, body, origin (kept, patched, rechunked).

    ``actions(slug, url, action)`` says what happens to each group of a slug and source: deleted groups are left out,
    orphans and sound groups stay, PATCH gets ``date`` and ``speaker`` where they are given, RECHUNK is cut anew from the
    whole text of its source in ``documents(url, collection, full_text)``, one text a url. Slugs may repeat; nulls match no
    action and stay.
    """
    cols = ["chunk_id", "slug", "source_url", "collection", "date_iso", "speaker", "page_number", "chunk_index", "token_count", "text", "body"]
    told = chunks.join(actions.select("slug", F.col("url").alias("source_url"), "action"), ["slug", "source_url"], "left").withColumn("action", F.coalesce("action", F.lit("OK")))
    kept = told.where("action in ('OK', 'KEEP')").select(*cols, F.lit("kept").alias("origin"))
    mended = patched(told.where("action = 'PATCH'"), date, speaker).select(*cols, F.lit("patched").alias("origin"))
    groups = actions.where("action = 'RECHUNK'").select("slug", "url").distinct()
    texts = documents.groupBy("url").agg(F.min_by(F.struct("collection", "full_text"), "full_text").alias("d")).select("url", "d.*")
    sources = groups.join(texts, "url").withColumn("doc", F.xxhash64("slug", "url"))
    pieces = split_documents(sources.select("doc", "collection", F.col("full_text").alias("text")))
    joined = pieces.join(sources.select("doc", "slug", F.col("url").alias("source_url"), "collection"), "doc")
    none = lambda t: F.lit(None).cast(t)
    fresh = joined.withColumns({"date_iso": none("string"), "speaker": none("string"), "page_number": none("int")})
    text = F.concat(context_header(*[F.col(c) for c in ("date_iso", "slug", "speaker", "collection", "page_number")]), F.lit("\n"), "body")
    fresh = fresh.withColumns({
        "text": text, "token_count": offline_tokens(text), "chunk_id": F.concat_ws("::", "collection", "slug", F.format_string("%04d", "chunk_index")),
        "chunk_index": F.col("chunk_index").cast("int"),
    }).select(*cols, F.lit("rechunked").alias("origin"))
    return kept.unionByName(mended).unionByName(fresh)


def repair_action(tokens_high: Column, n_bad: Column, orphan: Column, duplicate: Column) -> Column:
    """What happens to a group of chunks: DELETE a duplicate, KEEP an orphan, RECHUNK when a chunk is too large, PATCH."""
    return F.when(duplicate, "DELETE").when(orphan, "KEEP").when(tokens_high > 600, "RECHUNK").when(n_bad > 0, "PATCH").otherwise("OK")


def before_first(chunks: DataFrame, prefix: Column) -> DataFrame:
    """The chunk before each chunk in its slug, found on the prefix of the slug and the index less one:
    chunk_row, before_row. Equal prefixes make the join one on a key."""
    keyed = chunks.select("chunk_row", "chunk_index", prefix.alias("p"))
    prev = keyed.groupBy("p", (F.col("chunk_index") + 1).alias("chunk_index")).agg(F.max("chunk_row").alias("before_row"))
    return keyed.join(prev, ["p", "chunk_index"]).select("chunk_row", "before_row")
