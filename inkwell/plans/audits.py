"""Audit queries: counts, shares, order statistics, classes."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkwell.operators import audit as A
from inkwell.plans.registry import query
from inkwell.sources.tables import table


@query("""select coalesce(collection,'*') collection, count(*) chunks, count(distinct slug) docs, coalesce(sum(token_count),0)::bigint tokens,
round(avg(token_count),6) avg_tokens, grouping(collection)::bigint total from chunks group by rollup(collection)""")
def collection_stats(spark, sf):
    c = table(spark, sf, "chunks")
    return c.rollup("collection").agg(
        F.count(F.lit(1)).alias("chunks"), F.count_distinct("slug").alias("docs"), F.coalesce(F.sum("token_count"), F.lit(0)).cast("bigint").alias("tokens"),
        F.round(F.avg("token_count"), 6).alias("avg_tokens"), F.grouping("collection").cast("bigint").alias("total"),
    ).withColumn("collection", F.coalesce("collection", F.lit("*")))


@query("select page_format, count(*) n, round(count(*)*1.0/sum(count(*)) over (),6)::double share from flat_documents group by 1")
def format_distribution(spark, sf):
    return A.shares(table(spark, sf, "flat_documents"), ["page_format"])


@query("select flag, count(*) n from (select unnest(validation_flags) flag from flat_documents) group by 1")
def flag_counts(spark, sf):
    return table(spark, sf, "flat_documents").select(F.explode("validation_flags").alias("flag")).groupBy("flag").agg(F.count(F.lit(1)).alias("n"))


_FLAGS = ("POSSIBLE_TRUNCATION", "SUSPICIOUSLY_SHORT", "MISSING_CONTENT_CONTAINER", "NO_SPEAKER_TURNS", "NO_PAGE_NUMBERS")


@query("select collection, " + ", ".join(f"count(*) filter (list_contains(validation_flags,'{f}')) \"{f}\"" for f in _FLAGS) + " from flat_documents group by 1")
def flag_matrix(spark, sf):
    df = table(spark, sf, "flat_documents")
    pairs = df.select("collection", F.explode(F.array_distinct("validation_flags")).alias("flag"))
    wide = pairs.groupBy("collection").pivot("flag", list(_FLAGS)).agg(F.count(F.lit(1)))
    return df.select("collection").distinct().join(wide, "collection", "left").na.fill(0)


@query("""select collection, count(*) docs, coalesce(sum(word_count),0)::bigint words, floor(avg(word_count))::bigint avg_words, min(word_count)::bigint min_words,
max(word_count)::bigint max_words, trunc(coalesce(sum(word_count),0)/1.3)::bigint est_tokens from flat_documents group by 1""")
def word_stats(spark, sf):
    w = F.coalesce(F.sum("word_count"), F.lit(0)).cast("bigint")
    return table(spark, sf, "flat_documents").groupBy("collection").agg(
        F.count(F.lit(1)).alias("docs"), w.alias("words"), F.floor(F.avg("word_count")).cast("bigint").alias("avg_words"),
        F.min("word_count").cast("bigint").alias("min_words"), F.max("word_count").cast("bigint").alias("max_words"),
        F.floor(w / 1.3).cast("bigint").alias("est_tokens"),
    )


@query("""select speaker, count(*) n from (select unnest(turns) t from session_documents) s, lateral (select s.t.speaker speaker)
where speaker <> '' group by 1 order by n desc, speaker limit 20""")
def speaker_top(spark, sf):
    t = table(spark, sf, "session_documents").select(F.explode("turns.speaker").alias("speaker")).where("speaker != ''")
    return t.groupBy("speaker").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "speaker").limit(20)


@query("""with s as (select speaker, count(*) n from (select unnest(speakers) speaker from session_documents) group by 1)
select split_part(speaker,' ',1) first_word, count(*) variants, max(n) top from s group by 1 having count(*) > 1 and max(n) > 5""")
def first_word_variants(spark, sf):
    s = table(spark, sf, "session_documents").select(F.explode("speakers").alias("speaker")).groupBy("speaker").agg(F.count(F.lit(1)).alias("n"))
    g = s.groupBy(F.substring_index("speaker", " ", 1).alias("first_word")).agg(F.count(F.lit(1)).alias("variants"), F.max("n").alias("top"))
    return g.where("variants > 1 and top > 5")


_POINTS = {"p25": (1, 4), "median": (1, 2), "p75": (3, 4), "p90": (9, 10), "p95": (95, 100)}


@query("""with l as (select collection, list(token_count order by token_count) x from chunks where token_count is not null group by 1)
select collection, len(x)::bigint n, """ + ", ".join(f"x[1+(len(x)*{a})//{b}]::bigint {k}" for k, (a, b) in _POINTS.items()) + " from l")
def order_stats(spark, sf):
    c = table(spark, sf, "chunks").withColumn("token_count", F.col("token_count").cast("bigint"))
    return A.order_statistics(c, ["collection"], "token_count", _POINTS)


@query("""with l as (select list(turn_count order by turn_count) x, avg(turn_count) m from session_documents where turn_count is not null)
select x[1+len(x)//2]::bigint median, round(m,6) mean, len(x)::bigint n from l where x is not null""")
def turn_stats(spark, sf):
    s = table(spark, sf, "session_documents").withColumn("turn_count", F.col("turn_count").cast("bigint"))
    median = A.order_statistics(s, [], "turn_count", {"median": (1, 2)})
    return median.crossJoin(s.agg(F.round(F.avg("turn_count"), 6).alias("mean"))).select("median", "mean", "n")


@query("""select case when token_count=0 then '0' when token_count<128 then '1-127' when token_count<256 then '128-255' when token_count<512 then '256-511'
when token_count<768 then '512-767' else '768+' end bucket, count(*) n from chunks where token_count >= 0 group by 1""")
def token_histogram(spark, sf):
    return A.histogram(table(spark, sf, "chunks"), "token_count", [0, 1, 128, 256, 512, 768])


@query("""select case when token_count<90 then 'SHORT' when token_count<=512 then 'OK' when token_count>512 then 'OVERLONG' end class, count(*) n,
round(count(*)*1.0/sum(count(*)) over (),6)::double share from chunks group by 1""")
def boundary_quality(spark, sf):
    return A.shares(table(spark, sf, "chunks").select(A.boundary_class(F.col("token_count")).alias("class")), ["class"])


@query("""select doc_type, count(*) n, round(count(title)*1.0/count(*),6)::double with_title, round(count(*) filter (full_text<>'')*1.0/count(*),6)::double with_text,
round(count(*) filter (len(page_numbers)>0)*1.0/count(*),6)::double with_pages from flat_documents group by 1""")
def doc_type_rates(spark, sf):
    rate = lambda c, n: F.round(A.count_of(c, n) / F.count(F.lit(1)), 6).alias(n)
    return table(spark, sf, "flat_documents").groupBy("doc_type").agg(
        F.count(F.lit(1)).alias("n"), rate(F.col("title").isNotNull(), "with_title"), rate(F.col("full_text") != "", "with_text"),
        rate(F.size("page_numbers") > 0, "with_pages"),
    )


@query("select date_source, coalesce(source,'') source, count(*) n, count(date_iso) dated from session_documents group by 1,2")
def date_source_breakdown(spark, sf):
    return table(spark, sf, "session_documents").groupBy("date_source", F.coalesce("source", F.lit("")).alias("source")).agg(
        F.count(F.lit(1)).alias("n"), F.count("date_iso").alias("dated")
    )


@query("select count(content_hash)-count(distinct content_hash) n_dup, count(*)-count(content_hash) no_hash from flat_documents")
def dup_hashes(spark, sf):
    h = F.col("content_hash")
    return table(spark, sf, "flat_documents").agg((F.count(h) - F.count_distinct(h)).alias("n_dup"), (F.count(F.lit(1)) - F.count(h)).alias("no_hash"))


@query("""select slug, count(*) chunks, count(date_iso) with_date, count(*) filter (coalesce(speaker,'')<>'') with_speaker,
arg_min(source_url, chunk_row) url from chunks group by 1""")
def slug_coverage(spark, sf):
    return table(spark, sf, "chunks").groupBy("slug").agg(
        F.count(F.lit(1)).alias("chunks"), F.count("date_iso").alias("with_date"), A.count_of(F.coalesce("speaker", F.lit("")) != "", "with_speaker"),
        F.min_by("source_url", "chunk_row").alias("url"),
    )


@query("""select split_part(doc_type,'_',1) prefix, count(*) docs, coalesce(sum(word_count),0)::bigint words, count(*) filter (len(validation_flags)>0) flagged,
count(*) filter (len(page_numbers)=0) no_pages from flat_documents group by 1""")
def prefix_volumes(spark, sf):
    return table(spark, sf, "flat_documents").groupBy(F.substring_index("doc_type", "_", 1).alias("prefix")).agg(
        F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("word_count"), F.lit(0)).cast("bigint").alias("words"),
        A.count_of(F.size("validation_flags") > 0, "flagged"), A.count_of(F.size("page_numbers") == 0, "no_pages"),
    )


@query("""select page_format, round(count(*) filter (len(page_numbers)>0)*1.0/count(*),6)::double covered,
round(avg(case when page_end>=page_start then (len(page_numbers)*1.0/(page_end-page_start+1)) end),6)::double density from session_documents group by 1""")
def page_coverage(spark, sf):
    span = F.col("page_end") - F.col("page_start") + 1
    return table(spark, sf, "session_documents").groupBy("page_format").agg(
        F.round(A.count_of(F.size("page_numbers") > 0, "x") / F.count(F.lit(1)), 6).alias("covered"),
        F.round(F.avg(F.when(F.col("page_end") >= F.col("page_start"), F.size("page_numbers") / span)), 6).alias("density"),
    )


@query("""select session_id, case when list_max(page_numbers)>30000 then 'HIGH_PAGE' when list_max(page_numbers)-list_min(page_numbers)>2000 then 'WIDE_V1'
when list_max(page_numbers)-list_min(page_numbers)>500 then 'WIDE_V2' end anomaly from session_documents
where list_max(page_numbers)>30000 or list_max(page_numbers)-list_min(page_numbers)>500""")
def page_anomalies(spark, sf):
    top, low = F.array_max("page_numbers"), F.array_min("page_numbers")
    kind = F.when(top > 30000, "HIGH_PAGE").when(top - low > 2000, "WIDE_V1").when(top - low > 500, "WIDE_V2")
    return table(spark, sf, "session_documents").select("session_id", kind.alias("anomaly")).where("anomaly is not null")


@query("""select coalesce(substr(date_iso,1,7),'') AS "month", count(*) records, min(page_start)::bigint first_page, max(page_end)::bigint last_page,
sum(word_count)::bigint words, count(distinct slug) slugs from session_documents group by 1""")
def month_records(spark, sf):
    return table(spark, sf, "session_documents").groupBy(F.coalesce(F.substring("date_iso", 1, 7), F.lit("")).alias("month")).agg(
        F.count(F.lit(1)).alias("records"), F.min("page_start").cast("bigint").alias("first_page"), F.max("page_end").cast("bigint").alias("last_page"),
        F.sum("word_count").cast("bigint").alias("words"), F.count_distinct("slug").alias("slugs"),
    )


@query("""select collection, count(*) n, count(date_iso) with_date, count(*)-count(date_iso) missing,
count(*) filter (date_iso is not null and (not regexp_full_match(date_iso,'\\d{4}-\\d{2}-\\d{2}') or try_strptime(date_iso,'%Y-%m-%d') is null
or year(try_strptime(date_iso,'%Y-%m-%d')) not between 1945 and 1954)) bad from chunks group by 1""")
def date_integrity(spark, sf):
    d = F.col("date_iso")
    day = F.try_to_date(d, "yyyy-MM-dd")
    bad = d.isNotNull() & (~d.rlike(r"^\d{4}-\d{2}-\d{2}$") | day.isNull() | ~F.year(day).between(1945, 1954))
    return table(spark, sf, "chunks").groupBy("collection").agg(
        F.count(F.lit(1)).alias("n"), F.count(d).alias("with_date"), (F.count(F.lit(1)) - F.count(d)).alias("missing"), A.count_of(bad, "bad")
    )


@query("""select count(*) chunks, coalesce(sum(token_count),0)::bigint tokens, round(avg(token_count),6) mean, min(token_count)::bigint low, max(token_count)::bigint high,
count(*) filter (token_count=0) zero, count(*) filter (token_count is null) unknown from chunks""")
def chunk_health(spark, sf):
    t = F.col("token_count")
    return table(spark, sf, "chunks").agg(
        F.count(F.lit(1)).alias("chunks"), F.coalesce(F.sum(t), F.lit(0)).cast("bigint").alias("tokens"), F.round(F.avg(t), 6).alias("mean"),
        F.min(t).cast("bigint").alias("low"), F.max(t).cast("bigint").alias("high"), A.count_of(t == 0, "zero"), A.count_of(t.isNull(), "unknown"),
    )


@query("""select collection, count(*) tries, count(*) filter (status='ok') ok, count(*) filter (coalesce(validation_flags,'')<>'') flagged,
count(distinct url) urls, count(distinct case when status='ok' then url end) done from crawl_log group by 1""")
def crawl_summary(spark, sf):
    ok = F.col("status") == "ok"
    return table(spark, sf, "crawl_log").groupBy("collection").agg(
        F.count(F.lit(1)).alias("tries"), A.count_of(ok, "ok"), A.count_of(F.coalesce("validation_flags", F.lit("")) != "", "flagged"),
        F.count_distinct("url").alias("urls"), F.count_distinct(F.when(ok, F.col("url"))).alias("done"),
    )


_CHECKS = {
    "dated": "100*count(date_iso) >= 90*count(*)", "speakers": "100*count(*) filter (speaker_count>1) >= 95*count(*)",
    "turns": "count(*) filter (turn_count=0) = 0", "pages": "100*count(*) filter (len(page_numbers)>0) >= 90*count(*)",
    "hashes": "count(content_hash) = count(distinct content_hash)", "flags": "100*count(*) filter (len(validation_flags)>0) <= 10*count(*)",
    "words": "sum(word_count) > 1000", "sources": "count(source) > 0",
}


@query("with b as (select " + ", ".join(f"coalesce({v},false) {k}" for k, v in _CHECKS.items()) + " from session_documents) select "
       + ", ".join(f"{k}" for k in _CHECKS) + ", (" + "+".join(f"{k}::int" for k in _CHECKS) + ")::bigint passed, (100*(" + "+".join(f"{k}::int" for k in _CHECKS)
       + f")//{len(_CHECKS)})::bigint score from b")
def readiness_score(spark, sf):
    s, n = table(spark, sf, "session_documents"), F.count(F.lit(1))
    checks = {
        "dated": 100 * F.count("date_iso") >= 90 * n, "speakers": 100 * A.count_of(F.col("speaker_count") > 1, "x") >= 95 * n,
        "turns": A.count_of(F.col("turn_count") == 0, "x") == 0, "pages": 100 * A.count_of(F.size("page_numbers") > 0, "x") >= 90 * n,
        "hashes": F.count("content_hash") == F.count_distinct("content_hash"), "flags": 100 * A.count_of(F.size("validation_flags") > 0, "x") <= 10 * n,
        "words": F.sum("word_count") > 1000, "sources": F.count("source") > 0,
    }
    row = s.agg(*[F.coalesce(c, F.lit(False)).alias(k) for k, c in checks.items()])
    passed = sum((F.col(k).cast("bigint") for k in checks), F.lit(0).cast("bigint"))
    return row.withColumn("passed", passed).withColumn("score", F.floor(100 * F.col("passed") / len(checks)).cast("bigint"))


@query("""with m as (select count(*) filter (title is null) no_title, count(*) filter (word_count is null) no_words, count(*) filter (len(page_numbers)=0) no_pages,
count(*) filter (content_hash is null) no_hash, count(*) n from flat_documents)
select metric, affected, case when affected*5 > n then 'HIGH' when affected*20 > n then 'MEDIUM' else 'LOW' end priority
from m, lateral (values ('title',no_title),('word_count',no_words),('page_numbers',no_pages),('content_hash',no_hash)) t(metric,affected) where affected > 0""")
def fix_list(spark, sf):
    m = table(spark, sf, "flat_documents").agg(
        A.count_of(F.col("title").isNull(), "title"), A.count_of(F.col("word_count").isNull(), "word_count"), A.count_of(F.size("page_numbers") == 0, "page_numbers"),
        A.count_of(F.col("content_hash").isNull(), "content_hash"), F.count(F.lit(1)).alias("n"),
    )
    long = m.unpivot(["n"], ["title", "word_count", "page_numbers", "content_hash"], "metric", "affected").where("affected > 0")
    level = F.when(F.col("affected") * 5 > F.col("n"), "HIGH").when(F.col("affected") * 20 > F.col("n"), "MEDIUM").otherwise("LOW")
    return long.select("metric", "affected", level.alias("priority"))


@query("""select flat_id, case when list_contains(validation_flags,'REDIRECT_STUB') then 'STUB' when coalesce(word_count,0)=0 then 'NO_WORDS'
when coalesce(full_text,'')='' then 'NO_TEXT' when len(page_numbers)=0 then 'NO_PAGES' else 'KEPT' end reason from flat_documents""")
def skip_reasons(spark, sf):
    reason = (
        F.when(F.array_contains("validation_flags", "REDIRECT_STUB"), "STUB")
        .when(F.coalesce("word_count", F.lit(0)) == 0, "NO_WORDS")
        .when(F.coalesce("full_text", F.lit("")) == "", "NO_TEXT")
        .when(F.size("page_numbers") == 0, "NO_PAGES")
        .otherwise("KEPT")
    )
    return table(spark, sf, "flat_documents").select("flat_id", reason.alias("reason"))


@query("""select collection, count(*) n, count(*) filter (coalesce(date_iso,'')='') no_date, count(*) filter (coalesce(speaker,'')='') no_speaker,
count(*) filter (coalesce(date_iso,'')='' and coalesce(speaker,'')='') neither, count(*) filter (regexp_matches(ltrim(body),'^\\p{Ll}')) mid_sentence,
count(*) filter (length(body)=0) empty_body, count(*) filter (token_count<100) short from chunks group by 1""")
def chunk_gaps(spark, sf):
    blank = lambda c: F.coalesce(c, F.lit("")) == ""
    return table(spark, sf, "chunks").groupBy("collection").agg(
        F.count(F.lit(1)).alias("n"), A.count_of(blank("date_iso"), "no_date"), A.count_of(blank("speaker"), "no_speaker"),
        A.count_of(blank("date_iso") & blank("speaker"), "neither"), A.count_of(F.ltrim("body").rlike(r"^\p{Ll}"), "mid_sentence"),
        A.count_of(F.length("body") == 0, "empty_body"), A.count_of(F.col("token_count") < 100, "short"),
    )


@query("""select speaker, count(*) n from chunks where regexp_full_match(upper(speaker),'(MR|MRS|DR|COLONEL|GENERAL|MAJOR|PROFESSOR|MISS|MADAME)\\.?') group by 1""")
def title_only_speakers(spark, sf):
    only = F.upper("speaker").rlike(r"^(MR|MRS|DR|COLONEL|GENERAL|MAJOR|PROFESSOR|MISS|MADAME)\.?$")
    return table(spark, sf, "chunks").where(only).groupBy("speaker").agg(F.count(F.lit(1)).alias("n"))


@query("""with t(collection,target) as (values ('sessions',500),('judgment',40),('key_docs',20),('secondary',900),('trial',10)),
f as (select collection, count(distinct slug) n from chunks group by 1)
select t.collection, coalesce(n,0) n, t.target::bigint target, case when coalesce(n,0)>=t.target then 'OK' when coalesce(n,0)>=0.9*t.target then 'WARN' else 'SHORT' end status
from t left join f using(collection)
union all select f.collection, n, null, 'NO_TARGET' from f where collection not in (select collection from t)""")
def coverage_targets(spark, sf):
    targets = spark.createDataFrame([("sessions", 500), ("judgment", 40), ("key_docs", 20), ("secondary", 900), ("trial", 10)], "collection string, target bigint")
    found = table(spark, sf, "chunks").groupBy("collection").agg(F.count_distinct("slug").alias("n"))
    both = targets.join(found, "collection", "full").withColumn("n", F.coalesce("n", F.lit(0)))
    return both.select("collection", "n", "target", A.coverage_status(F.col("n"), F.col("target")).alias("status"))


@query("""select collection, chunk_row, rk from (select collection, chunk_row, row_number() over (partition by collection order by slug, chunk_row) rk from chunks) where rk<=3""")
def first_samples(spark, sf):
    return A.first_rows(table(spark, sf, "chunks").select("collection", "slug", "chunk_row"), ["collection"], ["slug", "chunk_row"], 3).select("collection", "chunk_row", "rk")


@query('select collection, count(*) n, count(*) filter (coalesce(len(page_numbers),0)=0) AS "without" from flat_documents group by 1')
def no_page_numbers(spark, sf):
    none = F.coalesce(F.size("page_numbers"), F.lit(0)) <= 0
    return table(spark, sf, "flat_documents").groupBy("collection").agg(F.count(F.lit(1)).alias("n"), A.count_of(none, "without"))


@query("""select o_orderpriority, l_returnflag, count(*) n, round(sum(l_extendedprice*(1-l_discount)),2) revenue, round(avg(l_quantity),6) qty
from lineitem join orders on l_orderkey=o_orderkey where l_shipdate < timestamp '1998-09-02' group by 1,2""")
def order_revenue(spark, sf):
    l, o = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    j = l.where(F.col("l_shipdate") < F.lit("1998-09-02").cast("timestamp_ntz")).join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    return j.groupBy("o_orderpriority", "l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.round(F.avg("l_quantity"), 6).alias("qty")
    )


@query("""with p as (select slug, min(page_number) low, max(page_number) high from chunks where page_number is not null group by 1)
select slug, case when high>30000 then 'HIGH_PAGE' when high-low>2000 then 'WIDE_V1' else 'WIDE_V2' end anomaly from p where high>30000 or high-low>2""")
def slug_page_spans(spark, sf):
    p = table(spark, sf, "chunks").where("page_number is not null").groupBy("slug").agg(F.min("page_number").alias("low"), F.max("page_number").alias("high"))
    kind = F.when(F.col("high") > 30000, "HIGH_PAGE").when(F.col("high") - F.col("low") > 2000, "WIDE_V1").when(F.col("high") - F.col("low") > 2, "WIDE_V2")
    return p.select("slug", kind.alias("anomaly")).where("anomaly is not null")


@query("""select upper(regexp_extract(speaker,'^([A-Za-z]+\\.?)',1)) first_word, count(*) n from chunks
where regexp_full_match(upper(regexp_extract(speaker,'^([A-Za-z]+\\.?)',1)),'(MR|MRS|DR|COLONEL|GENERAL|MAJOR|PROFESSOR|MISS|MADAME)\\.?') group by 1""")
def titles_first(spark, sf):
    first = F.upper(F.regexp_extract("speaker", r"^([A-Za-z]+\.?)", 1))
    only = first.rlike(r"^(MR|MRS|DR|COLONEL|GENERAL|MAJOR|PROFESSOR|MISS|MADAME)\.?$")
    return table(spark, sf, "chunks").where(only).groupBy(first.alias("first_word")).agg(F.count(F.lit(1)).alias("n"))
