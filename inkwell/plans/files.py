"""Round trips through files: each query writes a table to the shared folder by a sink and reads it back by a source."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkwell.functions.text import offline_tokens
from inkwell.operators import repair as P
from inkwell.operators import retrieval as R
from inkwell.plans.registry import query
from inkwell.sources import files as I
from inkwell.sources import sinks as K
from inkwell.sources.shared import scratch
from inkwell.sources.tables import table


@query("select flat_id, url, full_text, word_count, collection from flat_documents")
def io_documents(spark, sf):
    docs = table(spark, sf, "flat_documents").select("flat_id", "url", "full_text", "word_count", "collection")
    folder = scratch(spark)
    K.write_documents(docs, folder)
    return spark.read.schema(docs.schema).json(folder)


@query('select item_id, "text", lang, (select count(*) from eval_passages) files from eval_passages')
def io_json_folder(spark, sf):
    docs = table(spark, sf, "eval_passages")
    folder = scratch(spark)
    docs.write.option("maxRecordsPerFile", 1).json(folder)  # a document a file
    found = I.documents_in(spark, folder, docs.schema)
    n = found.agg(F.count_distinct("file").alias("files"))
    return found.select("item_id", "text", "lang").join(n, F.lit(True))  # one row


@query("""select log_id, url, collection, date_iso, status, char_count, turn_count, speaker_count, page_format, nullif(validation_flags,'') validation_flags,
scrape_timestamp, logged_at from crawl_log""")
def io_crawl_log(spark, sf):
    log = table(spark, sf, "crawl_log").selectExpr(*[c.split()[0] for c in I.CRAWL_LOG.split(", ")])
    folder = scratch(spark)
    for half in (0, 1):  # two runs append to one log
        K.append_log(log.where(F.col("log_id") % 2 == half), folder)
    return I.read_crawl_log(spark, folder)


@query("select url, arg_max(status, logged_at::varchar||lpad(log_id::varchar,20,'0')) status from crawl_log group by 1 having count(*) filter (status='ok') = 0")
def io_failures(spark, sf):
    folder = scratch(spark)
    K.write_failures(table(spark, sf, "crawl_log"), folder)
    return spark.read.schema("url string, status string").json(folder)


@query("""select 'summary' part, collection name, count(*) documents, count(distinct url) urls from flat_documents group by 2
union all select 'urls', url, null, null from (select distinct url from flat_documents)""")
def io_summary(spark, sf):
    folder = scratch(spark)
    K.write_summary(table(spark, sf, "flat_documents"), folder)
    s = spark.read.schema("collection string, documents bigint, urls bigint").json(f"{folder}/summary")
    none = F.lit(None).cast("bigint")
    urls = spark.read.text(f"{folder}/urls").select(F.lit("urls").alias("part"), F.col("value").alias("name"), none.alias("documents"), none.alias("urls"))
    return s.select(F.lit("summary").alias("part"), F.col("collection").alias("name"), "documents", "urls").unionByName(urls)


_PASSAGE = ("chunk_row", "chunk_id", "text", "collection", "speaker", "token_count")


@query(f"""select {", ".join(f'"{c}"' for c in _PASSAGE)} from chunks""")
def io_passages(spark, sf):
    c = table(spark, sf, "chunks").select(*_PASSAGE)
    folder = scratch(spark)
    K.write_passages(c.where("chunk_row % 2 = 0"), folder)
    K.write_passages(c.where("chunk_row % 2 = 1"), folder, append=True)
    return I.read_json_lines(spark, folder, c.schema)


@query("select collection, count(*) passages, sum(token_count)::bigint tokens from chunks group by 1")
def io_dry_run(spark, sf):
    return K.write_passages(table(spark, sf, "chunks"), scratch(spark), dry_run=True)


@query("""select vec_id id, round(embedding[1]/sqrt(list_sum(list_transform(embedding, lambda x: x::double*x::double))),6)::double first,
round(sqrt(list_sum(list_transform(embedding, lambda x: x::double*x::double)))/sqrt(list_sum(list_transform(embedding, lambda x: x::double*x::double))),6) norm from embeddings""")
def io_dense_index(spark, sf):
    v = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    none = spark.createDataFrame([], "token string, id bigint, w bigint")
    folder = scratch(spark)
    for half in (0, 1):  # new vectors are added to the old ones
        K.write_index(v.where(F.col("id") % 2 == half), none, v.where(F.col("id") % 2 == half).select("id"), folder, append=half == 1)
    d = spark.read.parquet(f"{folder}/dense")
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x))
    return d.select("id", F.round(F.col("vec")[0], 6).alias("first"), F.round(norm, 6).alias("norm"))


@query("""with t as (select doc_id id, unnest(regexp_extract_all(lower("text"), '\\p{L}+')) token from documents) select token, id, count(*) w from t group by 1,2""")
def io_sparse_lines(spark, sf):
    d = table(spark, sf, "documents")
    folder = scratch(spark)
    K.write_sparse_lines(R.token_counts(d.select(F.col("doc_id").alias("id"), "text")), d.select(F.col("doc_id").alias("id"), "source"), folder)
    lines = I.read_json_lines(spark, f"{folder}/sparse", spark.createDataFrame([], "id bigint, weights map<string,bigint>").schema)
    return lines.select(F.explode("weights").alias("token", "w"), "id").select("token", "id", "w")


@query("select chunk_id, count(*) n from chunks where chunk_id not in (select chunk_id from chunks where loaded_at < timestamp '2025-01-20') group by 1")
def io_resume(spark, sf):
    c = table(spark, sf, "chunks")
    folder = scratch(spark)
    nothing = I.read_progress(spark, folder).count()
    K.append_progress(c.where(F.col("loaded_at") < F.lit("2025-01-20").cast("timestamp")), folder, "chunk_id")
    done = I.read_progress(spark, folder).withColumnRenamed("id", "chunk_id")
    return P.not_done(c.select("chunk_id"), done, "chunk_id").groupBy("chunk_id").agg((F.count(F.lit(1)) + nothing).alias("n"))


@query("""select collection, n, (select count(*) from chunks) total, round((select count(*) from chunks)/8.0,1) per_second from (select collection, count(*) n from chunks group by 1)""")
def io_stats(spark, sf):
    folder = scratch(spark)
    K.write_stats(table(spark, sf, "chunks"), folder, 8.0)
    s = spark.read.schema("total bigint, by_collection map<string,bigint>, per_second double").json(folder)
    return s.select(F.explode("by_collection").alias("collection", "n"), "total", "per_second")


@query("""select 'formats' part, page_format name, count(*) n from flat_documents group by 2 union all select 'types', doc_type, count(*) from flat_documents group by 2""")
def io_report(spark, sf):
    f = table(spark, sf, "flat_documents")
    folder = scratch(spark)
    by = lambda c: f.groupBy(F.col(c).alias("name")).agg(F.count(F.lit(1)).alias("n"))
    K.write_report({"formats": by("page_format"), "types": by("doc_type")}, folder)
    one = "array<struct<name:string,n:bigint>>"
    r = spark.read.schema(f"formats {one}, types {one}").json(folder)
    part = lambda c: r.select(F.lit(c).alias("part"), F.inline(c))
    return part("formats").unionByName(part("types"))


@query("""select url, collection, 'ok' status, char_count, nullif(array_to_string(validation_flags,'|'),'') validation_flags, scrape_timestamp from flat_documents""")
def io_rebuilt_log(spark, sf):
    folder = scratch(spark)
    log = K.log_of_documents(table(spark, sf, "flat_documents"))
    K.append_log(log, folder)
    return I.read_crawl_log(spark, folder, "url string, collection string, status string, char_count int, validation_flags string, scrape_timestamp string")


@query("""select chunk_row, coalesce(speaker,'UNKNOWN') speaker, greatest(1,length("text")//4)::bigint token_count from chunks""")
def io_versions(spark, sf):
    folder = scratch(spark)
    K.write_version(table(spark, sf, "chunks").select("chunk_row", "text", "speaker", "token_count"), folder)
    old = I_current(spark, folder)
    # the new version is made of the one that is read
    K.write_version(old.withColumns({"speaker": F.coalesce("speaker", F.lit("UNKNOWN")), "token_count": offline_tokens(F.col("text")).cast("bigint")}), folder)
    return I_current(spark, folder).select("chunk_row", "speaker", "token_count")


I_current = K.read_version


@query("""select row_number() over (order by doc_id) - 1 AS ordinal, doc_id from documents""")
def io_ordinals(spark, sf):
    folder = scratch(spark)
    table(spark, sf, "documents").select("doc_id").repartitionByRange("doc_id").sortWithinPartitions("doc_id").write.json(folder)
    lines = I.read_json_lines(spark, folder, spark.createDataFrame([], "doc_id bigint").schema)
    return I.with_ordinals(lines).select("ordinal", "doc_id")


@query("""select s.slug, coalesce(min(s.session_id), (select min(flat_id) from flat_documents)) found from session_documents s where s.slug = (select min(slug) from session_documents) group by 1""")
def point_lookup(spark, sf):
    s = table(spark, sf, "session_documents").select("session_id", "url", F.concat("slug", F.lit(".json")).alias("file"), "slug")
    slug = s.agg(F.min("slug")).first()[0]
    one = I.by_slug(s.withColumn("file", F.concat("slug", F.lit("."), F.lpad(F.col("session_id").cast("string"), 12, "0"))), slug)
    return I.first_found(one, s.withColumn("file", F.lit("")).select(one.columns), F.col("slug") == slug).select("slug", F.col("session_id").alias("found"))
