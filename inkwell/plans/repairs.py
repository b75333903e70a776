"""Resume, duplicate, orphan and patch queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkwell.functions import dates, text
from inkwell.operators import audit as A
from inkwell.operators import repair as P
from inkwell.plans.registry import query
from inkwell.sources.tables import table


@query("select distinct url from crawl_log where url not in (select url from crawl_log where status='ok')")
def crawl_todo(spark, sf):
    log = table(spark, sf, "crawl_log")
    return P.not_done(log.select("url"), log.where("status = 'ok'"), "url").distinct()


@query("select chunk_id, count(*) n from chunks where chunk_id not in (select chunk_id from chunks where loaded_at < timestamp '2025-01-20') group by 1")
def embed_todo(spark, sf):
    c = table(spark, sf, "chunks")
    done = c.where(F.col("loaded_at") < F.lit("2025-01-20").cast("timestamp"))
    return P.not_done(c.select("chunk_id"), done, "chunk_id").groupBy("chunk_id").agg(F.count(F.lit(1)).alias("n"))


_MARKED = """c as (select chunk_row, slug, case when chunk_index % 3 = 0 then source_url||'#x' else source_url end source_url from chunks)"""


def _marked(spark, sf):
    return table(spark, sf, "chunks").withColumn(
        "source_url", F.when(F.col("chunk_index") % 3 == 0, F.concat("source_url", F.lit("#x"))).otherwise(F.col("source_url"))
    )


@query(f"""with {_MARKED}, g as (select slug, arg_min(source_url, chunk_row) url, count(*) n from c group by 1)
select slug, url, n from g where contains(url,'#') and regexp_matches(split_part(url,'#',1),'/\\d{{2}}-\\d{{2}}-\\d{{2}}[^/]*$')
and split_part(url,'#',1) in (select split_part(url,'#',1) from session_documents)""")
def session_duplicates(spark, sf):
    found = P.session_duplicates(_marked(spark, sf), table(spark, sf, "session_documents"), r"/\d{2}-\d{2}-\d{2}[^/]*$")
    return found.select("slug", "url", "n")


@query("""with g as (select slug, split_part(source_url,'#',1) base, count(*) n from chunks group by 1,2), d as (select split_part(url,'#',1) base, min(url) doc_url from flat_documents group by 1)
select slug, base, n, doc_url from g left join d using(base)""")
def chunk_sources(spark, sf):
    return P.with_source(table(spark, sf, "chunks"), table(spark, sf, "flat_documents")).select("slug", "base", "n", "doc_url")


_DUPLICATES = f"""{_MARKED}, dg as (select slug, arg_min(source_url, chunk_row) url from c group by 1),
dup as (select slug from dg where contains(url,'#') and regexp_matches(split_part(url,'#',1),'/\\d{{2}}-\\d{{2}}-\\d{{2}}[^/]*$')
and split_part(url,'#',1) in (select split_part(url,'#',1) from session_documents))"""


@query(f"""with {_DUPLICATES}, d as (select distinct url from flat_documents), g as (select slug, source_url, max(token_count) hi, count(*) filter (speaker is null or date_iso is null) bad,
count(*) n from chunks group by 1,2)
select case when g.slug in (select slug from dup) then 'DELETE' when d.url is null then 'KEEP' when hi > 600 then 'RECHUNK' when bad > 0 then 'PATCH' else 'OK' end action, count(*) groups, sum(n)::bigint chunks
from g left join d on g.source_url=d.url group by 1""")
def repair_actions(spark, sf):
    return _actions(spark, sf).groupBy("action").agg(F.count(F.lit(1)).alias("groups"), F.sum("n").alias("chunks"))


def _actions(spark, sf):
    """What happens to each group of chunks: slug, url, n, action."""
    c = table(spark, sf, "chunks")
    g = c.groupBy("slug", F.col("source_url").alias("url")).agg(
        F.max("token_count").alias("hi"), A.count_of(F.col("speaker").isNull() | F.col("date_iso").isNull(), "bad"), F.count(F.lit(1)).alias("n")
    )
    docs = table(spark, sf, "flat_documents").select("url", F.lit(1).alias("there")).distinct()
    twice = P.session_duplicates(_marked(spark, sf), table(spark, sf, "session_documents"), r"/\d{2}-\d{2}-\d{2}[^/]*$").select("slug", F.lit(True).alias("twice"))
    action = P.repair_action(F.col("hi"), F.col("bad"), F.col("there").isNull(), F.coalesce("twice", F.lit(False)))
    return g.join(docs, "url", "left").join(twice, "slug", "left").select("slug", "url", "n", action.alias("action"))


@query("""with d as (select url, min(scrape_timestamp[1:10]) d from flat_documents group by 1),
p as (select c.chunk_row, coalesce(d.d, date_iso) date_iso, slug, speaker, collection, page_number, body from chunks c left join d on c.source_url=d.url),
t as (select chunk_row, date_iso, '['||concat_ws(' | ', 'Date: '||nullif(date_iso,''), 'Source: '||slug, 'Speaker: '||nullif(speaker,''), 'Collection: '||collection,
'Page: '||page_number)||']'||chr(10)||body as "text" from p)
select chunk_row, date_iso, "text", greatest(1, length("text")//4)::bigint token_count from t""")
def patched_chunks(spark, sf):
    dates = table(spark, sf, "flat_documents").groupBy(F.col("url").alias("source_url")).agg(F.min(F.substring("scrape_timestamp", 1, 10)).alias("new_date"))
    c = table(spark, sf, "chunks").join(dates, "source_url", "left")
    return P.patched(c, F.col("new_date"), F.lit(None).cast("string")).select("chunk_row", "date_iso", "text", F.col("token_count").cast("bigint").alias("token_count"))


@query("""select a.chunk_row, max(b.chunk_row) before_row from chunks a join chunks b on substr(a.slug,1,10)=substr(b.slug,1,10) and b.chunk_index=a.chunk_index-1 group by 1""")
def prev_chunk(spark, sf):
    return P.before_first(table(spark, sf, "chunks"), F.substring("slug", 1, 10))


@query("select url, log_id, status from crawl_log qualify row_number() over (partition by url order by log_id) = 1")
def keep_first_urls(spark, sf):
    return A.keep_first(table(spark, sf, "crawl_log").select("url", "log_id", "status"), ["url"], "log_id")


@query("select coalesce(date_iso,'') AS hearing, session_id, slug from session_documents qualify row_number() over (partition by coalesce(date_iso,'') order by session_id desc) = 1")
def keep_last_session(spark, sf):
    s = table(spark, sf, "session_documents").select(F.coalesce("date_iso", F.lit("")).alias("hearing"), "session_id", "slug")
    return A.keep_last(s, ["hearing"], "session_id")


@query("""select 'crawled_only' part, count(*) n from (select url from crawl_log except select url from flat_documents)
union all select 'both', count(*) from (select url from crawl_log intersect select url from flat_documents)
union all select 'all', count(*) from (select url from crawl_log union select url from flat_documents)
union all select 'rows', (select count(*) from crawl_log)+(select count(*) from flat_documents)""")
def set_operations(spark, sf):
    a, b = table(spark, sf, "crawl_log").select("url"), table(spark, sf, "flat_documents").select("url")
    part = lambda df, name: df.agg(F.lit(name).alias("part"), F.count(F.lit(1)).alias("n"))
    return (
        part(a.subtract(b), "crawled_only").unionByName(part(a.intersect(b), "both")).unionByName(part(a.union(b).distinct(), "all")).unionByName(part(a.union(b), "rows"))
    )


@query("""select s.session_id, list_sort(list_distinct(list_concat(s.page_numbers, coalesce(list_filter(list_transform(s.turns, lambda t: t.page_number), lambda p: p is not null),[]))))
 pages, list_min(s.page_numbers)::bigint low, list_max(s.page_numbers)::bigint high from session_documents s""")
def page_unions(spark, sf):
    turn_pages = F.array_compact(F.col("turns.page_number"))
    pages = F.array_sort(F.array_union("page_numbers", F.coalesce(turn_pages, F.array().cast("array<int>"))))
    return table(spark, sf, "session_documents").select(
        "session_id", pages.alias("pages"), F.array_min("page_numbers").cast("bigint").alias("low"), F.array_max("page_numbers").cast("bigint").alias("high")
    )


def _rewritten(spark, sf):
    c, docs = table(spark, sf, "chunks"), table(spark, sf, "flat_documents")
    dated = docs.groupBy(F.col("url").alias("source_url")).agg(F.min(F.substring("scrape_timestamp", 1, 10)).alias("new_date"))
    return P.rewritten(c.join(dated, "source_url", "left"), _actions(spark, sf), docs, F.col("new_date"), F.lit(None).cast("string"))


_ACTIONS = f"""{_DUPLICATES}, d as (select distinct url from flat_documents), g as (select slug, source_url, max(token_count) hi, count(*) filter (speaker is null or date_iso is null) bad from chunks group by 1,2),
act as (select g.slug, g.source_url, case when g.slug in (select slug from dup) then 'DELETE' when d.url is null then 'KEEP' when hi > 600 then 'RECHUNK' when bad > 0 then 'PATCH' else 'OK' end action from g left join d on g.source_url=d.url)"""


@query()
def rewritten_chunks(spark, sf):
    return _rewritten(spark, sf)


@query(f"""with {_ACTIONS}, nd as (select url, min(scrape_timestamp[1:10]) d from flat_documents group by 1)
select case when action = 'PATCH' then 'patched' else 'kept' end origin, c.chunk_id, case when action = 'PATCH' then coalesce(nd.d, c.date_iso) else c.date_iso end date_iso, count(*) n
from chunks c join act a on a.slug=c.slug and a.source_url=c.source_url left join nd on nd.url=c.source_url where action in ('KEEP','OK','PATCH') group by 1,2,3""")
def untouched_and_patched(spark, sf):
    return _rewritten(spark, sf).where("origin != 'rechunked'").groupBy("origin", "chunk_id", "date_iso").agg(F.count(F.lit(1)).alias("n"))


@query(f"""with {_ACTIONS}, k as (select slug, source_url from act where action <> 'DELETE')
select (select count(distinct source_url) from chunks) urls_before, (select count(distinct source_url) from k) urls_after,
(select count(distinct source_url) from act where action='DELETE') deleted_urls, (select count(distinct source_url) from act where action='KEEP') orphan_urls""")
def repair_delta(spark, sf):
    a = _actions(spark, sf)
    return a.agg(
        F.count_distinct("url").alias("urls_before"), F.count_distinct(F.when(F.col("action") != "DELETE", F.col("url"))).alias("urls_after"),
        F.count_distinct(F.when(F.col("action") == "DELETE", F.col("url"))).alias("deleted_urls"), F.count_distinct(F.when(F.col("action") == "KEEP", F.col("url"))).alias("orphan_urls"),
    )


# What is to be done with documents of a type, and the day of a type that names none.
_TODO = {"order": "keep", "affidavit": "check date", "report": "check date", "letter": "none", "minutes": "keep"}


@query("""with t(doc_type, todo) as (values ('order','keep'),('affidavit','check date'),('report','check date'),('letter','none'),('minutes','keep'))
select f.doc_type, t.todo, count(*) n from flat_documents f left join t using (doc_type) group by 1,2""")
def type_actions(spark, sf):
    f = table(spark, sf, "flat_documents")
    return f.groupBy("doc_type", dates.typed(F.col("doc_type"), _TODO).alias("todo")).agg(F.count(F.lit(1)).alias("n"))


@query("""with t(doc_type, day) as (select doc_type, case when doc_type = (select min(doc_type) from flat_documents) then '1951-01-01' end from (select distinct doc_type from flat_documents)),
x as (select flat_id, doc_type, try_strptime(nullif(regexp_extract(left(full_text,2000),'\\b(\\d{1,2} (January|February|March|April|May|June|July|August|September|October|November|December) \\d{4})\\b',1),''),'%-d %B %Y')::date txt from flat_documents)
select flat_id, coalesce(t.day, txt::varchar) AS "day", case when t.day is not null then 'doc_type' when txt is not null then 'text' else 'none' end source from x join t using (doc_type)""")
def cascade_dates(spark, sf):
    f = table(spark, sf, "flat_documents")
    first = f.agg(F.min("doc_type")).first()[0]
    by_type = F.to_date(dates.typed(F.col("doc_type"), {first: "1951-01-01"} if first else {}))
    day, source = dates.inferred_date(text.slug_of(F.col("url")), by_type, F.col("full_text"))
    return f.select("flat_id", day.cast("string").alias("day"), source.alias("source"))


@query("""select flat_id, case when upper(regexp_extract(replace(split_part(rtrim(url,'/'),'/',-1),'.asp',''),'([A-Za-z]+)$',1)) in ('DAYBOOK','REPORT','MORRIMOTT') then
upper(regexp_extract(replace(split_part(rtrim(url,'/'),'/',-1),'.asp',''),'([A-Za-z]+)$',1)) end speaker from flat_documents""")
def file_speakers(spark, sf):
    s = dates.file_speaker(text.slug_of(F.col("url")), ["Daybook", "Report", "Morrimott"])
    return table(spark, sf, "flat_documents").select("flat_id", s.alias("speaker"))


@query("""select flat_id, case when list_contains(validation_flags,'REDIRECT_STUB') then 'stub' when coalesce(word_count,0)=0 then 'no words' when page_numbers is null or len(page_numbers)=0 then 'no pages' else 'kept' end reason from flat_documents""")
def skip_labels(spark, sf):
    reason = F.when(F.array_contains("validation_flags", "REDIRECT_STUB"), "stub").when(F.coalesce("word_count", F.lit(0)) == 0, "no words").when(F.coalesce(F.size("page_numbers"), F.lit(0)) <= 0, "no pages")
    return table(spark, sf, "flat_documents").select("flat_id", F.coalesce(reason, F.lit("kept")).alias("reason"))


@query("""select collection, case when status='ok' then 'parse' when status in ('http_404','404') then 'missing' else 'retry' end route, case when regexp_matches(url,'/\\d{2}-\\d{2}-\\d{2}[^/]*$') then 'transcript' else 'flat' end parser,
count(*) n from crawl_log group by 1,2,3""")
def crawl_routes(spark, sf):
    route = F.when(F.col("status") == "ok", "parse").when(F.col("status").isin("http_404", "404"), "missing").otherwise("retry")
    parser = F.when(F.col("url").rlike(r"/\d{2}-\d{2}-\d{2}[^/]*$"), "transcript").otherwise("flat")
    return table(spark, sf, "crawl_log").groupBy("collection", route.alias("route"), parser.alias("parser")).agg(F.count(F.lit(1)).alias("n"))


@query("""with t as (select session_id, coalesce(nullif(date_iso,''), substr(scrape_timestamp,1,10)) d, speakers, word_count, page_start, page_end from session_documents),
w as (select distinct d from t where substr(d,9,2) in ('05','06','07')), s as (select d, unnest(speakers) sp, session_id, generate_subscripts(speakers,1) k from t),
f as (select d, sp, min(lpad(session_id::varchar,20,'0')||lpad(k::varchar,6,'0')) o from s group by 1,2)
select t.d AS day, count(*) records, min(page_start)::bigint low, max(page_end)::bigint high, sum(word_count)::bigint words,
coalesce((select string_agg(sp, ';' order by o) from (select sp, o from f where f.d=t.d order by o limit 3)),'') first_speakers from t where t.d in (select d from w) group by 1""")
def days_records(spark, sf):
    s = table(spark, sf, "session_documents").withColumn("day", F.coalesce(F.when(F.col("date_iso") != "", F.col("date_iso")), F.substring("scrape_timestamp", 1, 10)))
    s = s.where(F.substring("day", 9, 2).isin("05", "06", "07"))
    by = s.groupBy("day").agg(
        F.count(F.lit(1)).alias("records"), F.min("page_start").cast("bigint").alias("low"), F.max("page_end").cast("bigint").alias("high"), F.sum("word_count").cast("bigint").alias("words")
    )
    # first appearance of each speaker of a day, then the first three: aggregates, not a gathered list
    seen = s.select("day", "session_id", F.posexplode("speakers").alias("k", "sp")).groupBy("day", "sp").agg(F.min(F.struct("session_id", "k")).alias("o"))
    first = A.first_rows(seen, ["day"], ["o"], 3).groupBy("day").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o", "sp"))), lambda x: x["sp"]), ";").alias("first_speakers"))
    return by.join(first, "day", "left").withColumn("first_speakers", F.coalesce("first_speakers", F.lit("")))


@query("""with m as (select url, min(flat_id) pos from flat_documents group by 1) select url, pos from m""")
def menu_union(spark, sf):
    f = table(spark, sf, "flat_documents").select("url", F.col("flat_id").alias("pos"))
    return f.groupBy("url").agg(F.min("pos").alias("pos"))


@query("""select 'old' part, count(*) n from embeddings where vec_id % 2 = 0 union all select 'all', count(*) from embeddings""")
def vector_union(spark, sf):
    v = table(spark, sf, "embeddings").select("vec_id")
    old, new = v.where("vec_id % 2 = 0"), v.where("vec_id % 2 != 0")
    part = lambda df, name: df.agg(F.lit(name).alias("part"), F.count(F.lit(1)).alias("n"))
    return part(old, "old").unionByName(part(old.unionByName(P.not_done(new, old, "vec_id")), "all"))


@query("""with h as (select slug, chunk_row, source_url from chunks), a as (select distinct replace(split_part(rtrim(url,'/'),'/',-1),'.asp','') slug, 1 audited from flat_documents)
select coalesce(audited,0)::bigint audited, count(*) chunks, count(distinct h.slug) slugs from h left join a using (slug) group by 1""")
def audited_chunks(spark, sf):
    a = table(spark, sf, "flat_documents").select(text.slug_of(F.col("url")).alias("slug"), F.lit(1).alias("audited")).distinct()
    c = table(spark, sf, "chunks").select("slug").join(a, "slug", "left")
    return c.groupBy(F.coalesce("audited", F.lit(0)).cast("bigint").alias("audited")).agg(F.count(F.lit(1)).alias("chunks"), F.count_distinct("slug").alias("slugs"))


@query("""select collection, count(*) n from chunks where collection in ('secondary','vol1') group by 1""")
def chosen_collections(spark, sf):
    return table(spark, sf, "chunks").where(F.col("collection").isin("secondary", "vol1")).groupBy("collection").agg(F.count(F.lit(1)).alias("n"))


@query("""select count(*) filter (url is null) url, count(*) filter (title is null) title, count(*) filter (word_count is null) word_count, count(*) filter (content_hash is null) content_hash, count(*) n from flat_documents""")
def missing_keys(spark, sf):
    # which keys a document lacks is told from its JSON, as a key that is null is left out there
    keys = F.json_object_keys(F.to_json(F.struct("flat_id", "url", "title", "word_count", "content_hash")))
    d = table(spark, sf, "flat_documents").select(keys.alias("k"))
    lacks = lambda k: F.count_if(~F.array_contains("k", k)).alias(k)
    return d.agg(lacks("url"), lacks("title"), lacks("word_count"), lacks("content_hash"), F.count(F.lit(1)).alias("n"))


@query("""with t as (select min(logged_at) + (max(logged_at) - min(logged_at)) / 2 mid from crawl_log)
select distinct url from crawl_log where url not in (select url from crawl_log, t where status='ok' and logged_at < mid)""")
def crawl_todo_halfway(spark, sf):
    log = table(spark, sf, "crawl_log")
    mid = log.agg((F.min("logged_at") + (F.max("logged_at") - F.min("logged_at")) / 2).alias("mid"))
    done = log.where("status = 'ok'").join(mid, F.col("logged_at") < F.col("mid"))  # one row
    return P.not_done(log.select("url"), done, "url").distinct()
