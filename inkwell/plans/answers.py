"""Context blocks and citation checks over the corpus's own passages."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkwell.operators import answers as W
from inkwell.operators import audit as A
from inkwell.plans.registry import query
from inkwell.sources.tables import table

_SRC = """s as (select *, row_number() over (partition by slug order by chunk_index, chunk_row) n from chunks qualify n <= 5), """
_SRC += """h as (select slug, chunk_row, n, '[SOURCE '||n||' | '||collection||' | '||coalesce(nullif(date_iso,''),'date unknown')||' | speaker: '||coalesce(nullif(speaker,''),'-')||' | page: '
||coalesce(nullif(page_number,0)::varchar,'?')||' | slug: '||slug||']' head, trim(body,' ') body from s)"""


def _sources(spark, sf):
    return A.first_rows(table(spark, sf, "chunks"), ["slug"], ["chunk_index", "chunk_row"], 5)


@query(f"""with s as (select *, chunk_index + 1 n from chunks), {_SRC.split("qualify n <= 5), ")[1]} select slug, chunk_row, n::bigint n, head, length(body) chars from h""")
def source_headers(spark, sf):
    s = table(spark, sf, "chunks").withColumn("n", (F.col("chunk_index") + 1).cast("bigint"))
    b = W.source_block(*[F.col(c) for c in ("n", "collection", "date_iso", "speaker", "page_number", "slug", "body")])
    return s.select("slug", "chunk_row", "n", b.alias("b")).select("slug", "chunk_row", "n", F.col("b.head").alias("head"), F.length("b.body").cast("bigint").alias("chars"))


@query(f"""with recursive {_SRC}, m as (select slug, max(n) k from h group by 1), r(slug,n,used,txt,stop) as (select slug, 0::bigint, 0::bigint, '', false from m
union all select r.slug, r.n+1, case when r.stop or 2000-r.used-length(h.head)-1<=0 then r.used else r.used+length(h.head)+1+(case when length(h.body)>2000-r.used-length(h.head)-1
 then 2000-r.used-length(h.head)-1+16 else length(h.body) end)+2 end,
case when r.stop or 2000-r.used-length(h.head)-1<=0 then r.txt else r.txt||(case when r.used=0 then '' else chr(10)||chr(10) end)||h.head||chr(10)||
 (case when length(h.body)>2000-r.used-length(h.head)-1 then left(h.body,2000-r.used-length(h.head)-1)||'...  [truncated]' else h.body end) end,
r.stop or 2000-r.used-length(h.head)-1<=0 from r join h on h.slug=r.slug and h.n=r.n+1)
select r.slug, txt context from r join m on r.slug=m.slug and r.n=m.k""")
def context_blocks(spark, sf):
    s = _sources(spark, sf)
    b = W.source_block(*[F.col(c) for c in ("rk", "collection", "date_iso", "speaker", "page_number", "slug", "body")])
    blocks = F.transform(F.sort_array(F.collect_list(F.struct("rk", b.alias("b")))), lambda x: x["b"])
    return s.groupBy("slug").agg(blocks.alias("blocks")).select("slug", W.context_block(F.col("blocks"), 500).alias("context"))


@query()
def cited_answers(spark, sf):
    # an answer for each passage that cites sources 1 to 5 in several spellings, of three that it was given
    c = table(spark, sf, "chunks")
    i = F.pmod(F.col("chunk_row"), F.lit(5)) + 1
    said = F.concat(F.lit("[[SOURCE "), i, F.lit("]] and (SOURCE 2, p. 5) plus SOURCE 3. "), F.col("body"), F.lit("\n\nSources cited: [SOURCE 1]"))
    return W.verified(c.select(F.col("chunk_row").alias("id"), said.alias("answer"), F.lit(3).alias("num_sources")))


@query("""select vec_id, array_to_string(list_transform(embedding[1:8], lambda x: printf('%.4f', x::double)), ',') AS "key" from embeddings""")
def cache_keys(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", W.cache_key(F.col("embedding")).alias("key"))
