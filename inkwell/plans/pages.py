"""Page queries. The tables hold no markup, so pages are rendered from the documents and read back: a round trip."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkwell.operators import pages as H
from inkwell.plans.registry import query
from inkwell.sources.tables import table


def _safe(c):
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def _turn(t):
    """A turn under its label as stored; without one its text is a paragraph that follows the turn before."""
    label = F.when(t["speaker"].rlike(r"(?U)\S"), F.concat(F.lit("<b>"), _safe(t["speaker"]), F.lit(":</b> ")))
    return F.concat(F.lit("<p>"), F.coalesce(label, F.lit("")), _safe(F.coalesce(t["text"], F.lit(""))), F.lit("</p>"))


def _hearings(spark, sf):
    s = table(spark, sf, "session_documents")
    said = F.transform("turns", _turn)
    marks = F.array_join(F.transform("page_numbers", lambda n: F.concat(F.lit('<a name="'), n.cast("string"), F.lit('"></a>'))), "")
    links = F.array_join(F.transform("inline_links", lambda x: F.concat(F.lit('<a href="'), x["href"], F.lit('">'), _safe(x["text"]), F.lit("</a>"))), "")
    body = F.concat(
        F.lit('<html><body><table class="site-menu"><tr><td><a href="/">Home</a></td></tr></table><div class="text-properties"><div class="document-title">'),
        _safe(F.coalesce("title", F.lit(""))), F.lit("</div>"), marks, F.array_join(said, "\n"), links, F.lit("</div></body></html>"),
    )
    return s.select(F.col("session_id"), F.col("url").alias("page_url"), body.alias("html")).select(F.concat("page_url", F.lit("?"), "session_id").alias("url"), "html")


def _flat_pages(spark, sf):
    rows = F.transform(F.split("full_text", "\n"), lambda r: F.concat(F.lit("<p>"), _safe(r), F.lit("</p>")))
    body = F.concat(F.lit("<html><head><title>"), _safe(F.coalesce("title", F.lit(""))), F.lit('</title></head><body><div class="text-properties">'), F.array_join(rows, ""), F.lit("</div></body></html>"))
    return table(spark, sf, "flat_documents").select(F.concat("url", F.lit("?"), "flat_id").alias("url"), body.alias("html"))


@query("""with t as (select session_id, trim(t.speaker) sp, k from (select session_id, unnest(turns) t, generate_subscripts(turns,1) k from session_documents) where trim(coalesce(t.speaker,''))<>''),
n as (select session_id, row_number() over (partition by session_id order by k) k, count(*) over (partition by session_id) n,
regexp_full_match(upper(rtrim(sp,'.')),'MR|DR|ER|THE|MS|SIR|COL|GEN|LT|CPT|PROF') stub from t),
g as (select *, k - row_number() over (partition by session_id, stub order by k) g from n),
m as (select session_id, count(*) - count(*) filter (stub and k < n and pl % 2 = 1) turns from (select *, row_number() over (partition by session_id, stub, g order by k) pl from g) group by 1)
select url||'?'||session_id url, coalesce(m.turns,0) turns, len(list_distinct(list_filter(page_numbers, lambda p: p<=2000)))::bigint pages,
len(list_filter(inline_links, lambda x: not regexp_matches(x.href,'(?i)default\\.asp|accessibility|contact|library|purpose\\.asp|major\\.asp')))::bigint links,
coalesce(nullif(trim(title),''),'') title from session_documents left join m using (session_id)""")
def transcript_round_trip(spark, sf):
    size = lambda c: F.size(c).cast("bigint").alias(c if c != "inline_links" else "links")
    return H.transcripts(_hearings(spark, sf)).select(
        "url", size("turns"), F.size("page_numbers").cast("bigint").alias("pages"), size("inline_links"), F.coalesce("title", F.lit("")).alias("title")
    )


@query("""select url||'?'||flat_id url, coalesce(trim(title),'') title, len(list_filter(string_split(full_text,chr(10)), lambda r: trim(r)<>''))::bigint text_lines from flat_documents""")
def document_round_trip(spark, sf):
    d = H.documents(_flat_pages(spark, sf))
    rows = F.filter(F.split("full_text", "\n"), lambda r: F.trim(r) != "")
    return d.select("url", F.coalesce("title", F.lit("")).alias("title"), F.size(rows).cast("bigint").alias("text_lines"))


@query()
def page_transcripts(spark, sf):
    return H.transcripts(_hearings(spark, sf))


@query()
def page_documents(spark, sf):
    return H.documents(_flat_pages(spark, sf))


@query("""select url||'?'||session_id url, (select count(*) from (select unnest(turns) t) where trim(coalesce(t.speaker,''))<>'') bold,
1::bigint tables, (len(inline_links)+1)::bigint links, len(page_numbers)::bigint anchors from session_documents""")
def page_diagnoses(spark, sf):
    return H.diagnoses(_hearings(spark, sf)).select("url", "bold", "tables", "links", "anchors")


@query()
def menu_links(spark, sf):
    return H.content_links(_hearings(spark, sf), "https://", r"default\.asp|accessibility|contact")
