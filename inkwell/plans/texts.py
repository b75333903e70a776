"""Expressions over urls, dates and headers, and the passage queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkwell.functions import dates, text
from inkwell.operators import audit as A
from inkwell.operators import chunking as K
from inkwell.plans.registry import query
from inkwell.sources.tables import table


@query("""select flat_id, replace(split_part(rtrim(url,'/'),'/',-1),'.asp','') slug, split_part(url,'#',1) base, regexp_extract(url,'^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)',1) host,
left(regexp_replace(split_part(rtrim(url,'/'),'/',-1),'[^\\w]','_','g'),120) file_name from flat_documents""")
def url_parts(spark, sf):
    u = F.col("url")
    return table(spark, sf, "flat_documents").select(
        "flat_id", text.slug_of(u).alias("slug"), text.base_url(u).alias("base"), text.host_of(u).alias("host"), text.file_name_of(u).alias("file_name")
    )


_UD = "regexp_extract(url,'(\\d{2}-\\d{2})-(\\d{2})[^\\d]',0)"


@query("""with x as (select session_id, regexp_extract(url,'\\d{2}-\\d{2}-\\d{2}',0) s from session_documents)
select session_id, try_strptime(case when s<>'' then s[1:6]||'19'||s[7:8] end,'%m-%d-%Y')::date::varchar url_date,
strftime(try_strptime(case when s<>'' then s[1:6]||'19'||s[7:8] end,'%m-%d-%Y'),'%m-%d-%y') slug from x""")
def url_dates(spark, sf):
    d = dates.url_date(F.col("url"))
    return table(spark, sf, "session_documents").select("session_id", d.cast("string").alias("url_date"), dates.date_slug(d).alias("slug"))


@query("""select flat_id, try_strptime(nullif(regexp_extract(title,'(\\d{1,2} (January|February|March|April|May|June|July|August|September|October|November|December) \\d{4})',1),''),
'%-d %B %Y')::date::varchar title_date from flat_documents where title is not null""")
def title_dates(spark, sf):
    return table(spark, sf, "flat_documents").where("title is not null").select("flat_id", dates.text_date(F.col("title")).cast("string").alias("title_date"))


_EXAMPLES = [
    (1, "6 March 1946"), (2, "31 February 1946"), (3, "January 2, 1946"), (4, "2 Jan. 46"), (5, "2 Jan. '29"), (6, "no date"), (7, "4 Sept 45 and more"),
]


@query("""select * from (values (1,'6 March 1946','1946-03-06'),(2,'31 February 1946',null),(3,'January 2, 1946','1946-01-02'),(4,'2 Jan. 46','1946-01-02'),
(5,'2 Jan. ''29','2029-01-02'),(6,'no date',null),(7,'4 Sept 45 and more','1945-09-04')) t(i, said, iso)""")
def date_texts(spark, sf):
    df = spark.createDataFrame(_EXAMPLES, "i int, said string")
    return df.select(F.col("i").cast("bigint").alias("i"), "said", dates.text_date(F.col("said")).cast("string").alias("iso"))


@query("""select doc_type, case when t is not null then 'text' else 'none' end source, count(*) n from (select doc_type,
try_strptime(nullif(regexp_extract(left(full_text,2000),'\\b(\\d{1,2} (January|February|March|April|May|June|July|August|September|October|November|December) \\d{4})\\b',1),''),'%-d %B %Y') t
from flat_documents) group by 1,2""")
def inferred_dates(spark, sf):
    f = table(spark, sf, "flat_documents")
    _, source = dates.inferred_date(text.slug_of(F.col("url")), F.lit(None).cast("date"), F.col("full_text"))
    return f.groupBy("doc_type", source.alias("source")).agg(F.count(F.lit(1)).alias("n"))


_HEADER = """'['||concat_ws(' | ', 'Date: '||nullif(date_iso,''), 'Source: '||slug, 'Speaker: '||nullif(speaker,''), 'Collection: '||collection, 'Page: '||page_number)||']'"""


@query(f"""select chunk_row, collection||'::'||slug||'::'||printf('%04d', row_number() over (partition by collection, slug order by chunk_row)-1) new_id,
count(*) over (partition by collection, slug) total, {_HEADER} header from chunks""")
def chunk_ids_headers(spark, sf):
    cols = [F.col(c) for c in ("date_iso", "slug", "speaker", "collection", "page_number")]
    c = A.numbered(table(spark, sf, "chunks"), ["collection", "slug"], "chunk_row")
    return c.select(
        "chunk_row", F.concat_ws("::", "collection", "slug", F.format_string("%04d", "place")).alias("new_id"), F.col("group_rows").alias("total"), text.context_header(*cols).alias("header")
    )


@query("""select chunk_row, greatest(1, length("text")//4)::bigint tokens, len(string_split_regex(trim(body),'\\s+'))::bigint words, length(body)::bigint chars, md5(body) hash
from chunks where trim(body) <> ''""")
def text_counts(spark, sf):
    b = F.col("body")
    return table(spark, sf, "chunks").where("trim(body) != ''").select(
        "chunk_row", text.offline_tokens(F.col("text")).cast("bigint").alias("tokens"), text.word_count(b).cast("bigint").alias("words"),
        F.length(b).cast("bigint").alias("chars"), F.md5(b).alias("hash"),
    )


def _turns(spark, sf):
    t = table(spark, sf, "session_documents").select(F.col("session_id").alias("doc"), F.posexplode("turns").alias("turn_no", "t"))
    return t.select("doc", "turn_no", F.col("t.speaker").alias("speaker"), F.col("t.text").alias("text"), F.col("t.page_number").alias("page"))


@query("""with recursive t as (select session_id doc, k, trim(t.text) txt, t.speaker sp from (select session_id, unnest(turns) t, generate_subscripts(turns,1) k from session_documents) where trim(t.text) <> ''),
s as (select doc, k, unnest(p) txt, generate_subscripts(p,1) j from (select doc, k, string_split(regexp_replace(txt,'([.!?])\\s+','\\1'||chr(1),'g'),chr(1)) p from t where length(txt)//4 > 512)),
a(doc,k,j,total,c,txt) as (select doc, k, j, greatest(1,length(txt)//4), 0, txt from s where j=1
 union all select s.doc, s.k, s.j, case when a.total+greatest(1,length(s.txt)//4)>512 then greatest(1,length(s.txt)//4) else a.total+greatest(1,length(s.txt)//4) end,
 case when a.total+greatest(1,length(s.txt)//4)>512 then a.c+1 else a.c end, s.txt from a join s on s.doc=a.doc and s.k=a.k and s.j=a.j+1),
x as (select doc, k, c, trim(string_agg(txt,' ' order by j)) txt from a group by 1,2,3 union all select doc, k, 0, txt from t where length(txt)//4 <= 512),
u as (select doc, row_number() over (partition by doc order by k, c) i, k-1 turn_no, greatest(1,length(coalesce(nullif(sp,'')||': ','')||x.txt)//4) n from x join (select doc, k, sp from t) using (doc, k)),
r(doc,i,s,c,turn_no,n) as (select doc, i, n, 0, turn_no, n from u where i=1
 union all select u.doc, u.i, case when r.s+u.n>400 then u.n else r.s+u.n end, case when r.s+u.n>400 then r.c+1 else r.c end, u.turn_no, u.n from r join u on u.doc=r.doc and u.i=r.i+1)
select doc, c::bigint chunk_index, count(distinct turn_no) n_turns, min(turn_no)::bigint first_turn, sum(n)::bigint tokens from r group by 1,2""")
def greedy_pack(spark, sf):
    return K.packed_turns(_turns(spark, sf)).select("doc", "chunk_index", "n_turns", "first_turn", "tokens")


@query()
def session_chunks(spark, sf):
    docs = table(spark, sf, "session_documents").select(F.col("session_id").alias("doc"), "url", "date_iso", F.lit("sessions").alias("collection"))
    return K.finished(K.packed_turns(_turns(spark, sf)), docs)


@query()
def flat_chunks(spark, sf):
    f = table(spark, sf, "flat_documents")
    kept = f.where(~F.array_contains("validation_flags", "REDIRECT_STUB") & (F.coalesce("word_count", F.lit(0)) > 0))
    docs = kept.select(F.col("flat_id").alias("doc"), "collection", F.col("full_text").alias("text"), "url", F.lit(None).cast("string").alias("date_iso"))
    none = [F.lit(None).cast(t).alias(c) for c, t in (("speaker", "string"), ("page", "bigint"))]
    return K.finished(K.split_documents(docs).select("*", *none), docs)


@query("""with t as (select session_id, unnest(turns) t, generate_subscripts(turns,1) k from session_documents)
select session_id, k turn_no, last_value(t.page_number ignore nulls) over (partition by session_id order by k rows unbounded preceding)::bigint page from t""")
def page_fill(spark, sf):
    from pyspark.sql import Window

    w = Window.partitionBy("session_id").orderBy("turn_no").rowsBetween(Window.unboundedPreceding, 0)
    t = _turns(spark, sf).select(F.col("doc").alias("session_id"), (F.col("turn_no") + 1).cast("bigint").alias("turn_no"), "page")
    return t.select("session_id", "turn_no", F.last("page", ignorenulls=True).over(w).cast("bigint").alias("page"))


@query("""select session_id, array_to_string(list_transform(list_filter(turns, lambda t: coalesce(t.text,'')<>''),
lambda t: case when coalesce(t.speaker,'')<>'' then t.speaker||': '||t.text else t.text end), chr(10)||chr(10)) joined from session_documents""")
def joined_turns(spark, sf):
    said = F.filter("turns", lambda t: F.coalesce(t["text"], F.lit("")) != "")
    each = F.transform(said, lambda t: F.when(F.coalesce(t["speaker"], F.lit("")) != "", F.concat(t["speaker"], F.lit(": "), t["text"])).otherwise(t["text"]))
    return table(spark, sf, "session_documents").select("session_id", F.array_join(each, "\n\n").alias("joined"))


@query("""select collection, count(*) n, count(*) filter (regexp_matches(full_text,'(?i)adjourned')) said,
count(*) filter (not regexp_matches(right(full_text,120),'[.!?\\])]')) open_end from flat_documents group by 1""")
def ending_flags(spark, sf):
    return table(spark, sf, "flat_documents").groupBy("collection").agg(
        F.count(F.lit(1)).alias("n"), A.count_of(F.col("full_text").rlike("(?i)adjourned"), "said"),
        A.count_of(~F.right("full_text", F.lit(120)).rlike(r"[.!?\])]"), "open_end"),
    )
