"""Retrieval queries: every twentieth row is a query, against all rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkwell.operators import retrieval as R
from inkwell.plans.registry import query
from inkwell.sources.shared import materialise
from inkwell.sources.tables import table

QUERY = "id % 20 = 0"
_DENSE = """dq as (select q.vec_id qid, v.vec_id did, round(list_inner_product(q.embedding::double[], v.embedding::double[]),6) score
from embeddings q, embeddings v where q.vec_id % 20 = 0),
dense as (select *, row_number() over (partition by qid order by score desc, did) rk from dq qualify rk <= 100)"""
_TF = """tok as (select doc_id id, unnest(regexp_extract_all(lower(text), '\\p{L}+')) token from documents),
tf as (select token, id, count(*) w from tok group by 1,2)"""
_SPARSE = f"""{_TF}, sq as (select q.id qid, d.id did, sum(q.w*d.w)::bigint score from tf q join tf d using(token) where q.id % 20 = 0 group by 1,2),
sparse as (select *, row_number() over (partition by qid order by score desc, did) rk from sq qualify rk <= 100)"""
_FUSED = f"""{_DENSE}, {_SPARSE}, s2 as (select * from sparse where qid in (select vec_id from embeddings)),
u as (select coalesce(d.qid,s.qid) qid, coalesce(d.did,s.did) did, d.rk dense_rank, s.rk sparse_rank,
round(coalesce(1.0::double/(60+d.rk),0)+coalesce(1.0::double/(60+s.rk),0),12) rrf from dense d full join s2 s on d.qid=s.qid and d.did=s.did),
fused as (select *, row_number() over (partition by qid order by rrf desc, dense_rank asc nulls last, sparse_rank asc nulls last) rk from u qualify rk <= 25)"""


def _vectors(spark, sf):
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))


def _texts(spark, sf):
    return table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")


def _dense(spark, sf, k=100):
    v = _vectors(spark, sf)
    return R.dense_topk(v.where(QUERY), v, k)


def _sparse(spark, sf, k=100):
    p = materialise(R.token_counts(_texts(spark, sf)))
    return R.sparse_topk(p.where(QUERY), p, k)


def _fused(spark, sf):
    # texts and vectors share ids; only questions that have a vector are asked
    asked = _vectors(spark, sf).where(QUERY).select(F.col("id").alias("qid"))
    return R.fused(_dense(spark, sf), _sparse(spark, sf).join(asked, "qid", "left_semi"), 25)


@query(f"with {_DENSE} select qid, did, score, rk from dense")
def dense_topk(spark, sf):
    return _dense(spark, sf)


@query(f"with {_SPARSE} select qid, did, score, rk from sparse")
def sparse_topk(spark, sf):
    return _sparse(spark, sf)


@query(f"with {_FUSED} select qid, did, dense_rank, sparse_rank, rrf, rk from fused")
def hybrid_topk(spark, sf):
    return _fused(spark, sf)


@query(f"with {_DENSE} select qid, did, score rrf_score, rk from dense where rk <= 5")
def dense_only_topk(spark, sf):
    return _dense(spark, sf, 5).withColumnRenamed("score", "rrf_score")


@query(f"""with {_FUSED}, w as (select doc_id id, list_distinct(regexp_extract_all(lower(text), '\\p{{L}}+')) ws from documents),
r as (select f.qid, f.did, f.rk, round(1/(1+exp(3.0-len(list_intersect(q.ws,d.ws)))),6) rerank from fused f join w q on f.qid=q.id join w d on f.did=d.id)
select qid, did, rerank, row_number() over (partition by qid order by rerank desc, rk) new_rk from r qualify new_rk <= 5""")
def reranked_topk(spark, sf):
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0)))
    w = _texts(spark, sf).select("id", words.alias("ws"))
    return R.overlap_reranked(
        _fused(spark, sf), w.select(F.col("id").alias("qid"), F.col("ws").alias("qwords")), w.select(F.col("id").alias("did"), F.col("ws").alias("dwords")), 5
    )


@query(f"with {_TF} select token, id, w from tf")
def postings(spark, sf):
    return R.token_counts(_texts(spark, sf))


@query("""with t as (select chunk_row id, unnest(regexp_extract_all(lower(body), '\\p{L}+')) token from chunks where body is not null),
w as (select id, length(token)::bigint token_id, substr(token,1,3) token, (count(*)*1.0/10)::double w from t group by 1,2,3)
select id, token, round(arg_max(w, token_id),4) w from w where w > 0 group by 1,2""")
def token_maxpool(spark, sf):
    t = table(spark, sf, "chunks").select(F.col("chunk_row").alias("id"), F.explode(F.regexp_extract_all(F.lower("body"), F.lit(r"\p{L}+"), F.lit(0))).alias("t"))
    w = t.groupBy("id", F.length("t").cast("bigint").alias("token_id"), F.substring("t", 1, 3).alias("token")).agg((F.count(F.lit(1)) / 10).alias("w"))
    return R.max_pooled(w)


@query("""select vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x: x::double*x::double))),6) norm,
round(embedding[1]/sqrt(list_sum(list_transform(embedding, lambda x: x::double*x::double))),6)::double first from embeddings""")
def l2_normalise(spark, sf):
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    return table(spark, sf, "embeddings").select("vec_id", F.round(norm, 6).alias("norm"), F.round(R.normalised(F.col("embedding"))[0], 6).alias("first"))


@query("""with n as (select vec_id id, list_transform(embedding, lambda x: x::double/sqrt(list_sum(list_transform(embedding, lambda y: y::double*y::double)))) v from embeddings),
p as (select q.id qid, c.id did, round(list_inner_product(q.v,c.v),6) sim from n q, n c where q.id % 20 = 0 and c.id % 20 <> 0)
select qid, did best_id, sim, sim >= 0.97 hit from p qualify row_number() over (partition by qid order by sim desc, did) = 1""")
def best_cached_match(spark, sf):
    v = _vectors(spark, sf)
    return R.best_cached(v.where(QUERY), v.where(f"not ({QUERY})"), 0.97)
