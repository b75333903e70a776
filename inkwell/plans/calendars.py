"""Calendar queries over the hearing days and the order days."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkwell.functions import dates
from inkwell.operators import calendar as C
from inkwell.plans.registry import query
from inkwell.sources.tables import table

_DAYS = "d as (select distinct try_cast(date_iso as date) d from session_documents where try_cast(date_iso as date) is not null), "
_CAL = "cal as (select unnest(generate_series((select min(d) from d),(select max(d) from d),interval 1 day))::date d), "
_RECESS = "rec as (select unnest(generate_series(date '1951-12-20',date '1952-01-02',interval 1 day))::date d), "


def _miss(last: int) -> str:
    return f"m as (select d from cal where isodow(d)<={last + 1} and d not in (select d from d))"


def _days(spark, sf):
    return C.days_of(table(spark, sf, "session_documents"), F.try_to_date("date_iso", "yyyy-MM-dd"))


def _recess(spark):
    return spark.range(1).select(F.explode(F.sequence(F.lit("1951-12-20").cast("date"), F.lit("1952-01-02").cast("date"), F.expr("interval 1 day"))).alias("d"))


@query(f"with {_DAYS} {_CAL} {_miss(4)} select d::varchar d from m")
def missing_days(spark, sf):
    return C.missing_days(_days(spark, sf)).select(F.col("d").cast("string").alias("d"))


def _island_sql(source: str, gap: int, least: int) -> str:
    return f"""x as (select d, case when d-lag(d) over (order by d) <= {gap} then 0 else 1 end b from {source}), y as (select d, sum(b) over (order by d) g from x)
select min(d)::varchar first_day, max(d)::varchar last_day, count(*) n from y group by g having count(*)>={least}"""


@query(f"with {_DAYS} {_CAL} {_miss(4)}, {_island_sql('m', 3, 3)}")
def missing_islands(spark, sf):
    return _text(C.islands(C.missing_days(_days(spark, sf)), gap=3, least=3))


@query(f"""with {_DAYS} {_CAL} {_miss(5)}, k as (select d, row_number() over (order by d) k from cal where isodow(d)<=6),
g as (select k.d, k.k - row_number() over (order by k.d) g from k join m on k.d=m.d)
select min(d)::varchar first_day, max(d)::varchar last_day, count(*) n from g group by g having count(*)>=3""")
def workday_islands(spark, sf):
    days = _days(spark, sf)
    return _text(C.workday_islands(days, C.missing_days(days, 5), 5, 3))


@query(f"with {_DAYS} {_CAL} {_RECESS} {_miss(4)}, r as (select d from m where d not in (select d from rec)), {_island_sql('r', 3, 2)}")
def recess_islands(spark, sf):
    return _text(C.islands(C.missing_days(_days(spark, sf), 4, _recess(spark)), gap=3, least=2))


@query(f"with {_DAYS} {_CAL} {_miss(4)} select d::varchar d, (d-lag(d) over (order by d))::bigint gap from m qualify d-lag(d) over (order by d) > 7")
def gap_notes(spark, sf):
    from pyspark.sql import Window

    gap = F.datediff("d", F.lag("d").over(Window.partitionBy(F.lit(1)).orderBy("d"))).cast("bigint")
    return C.missing_days(_days(spark, sf)).select(F.col("d"), gap.alias("gap")).where("gap > 7").select(F.col("d").cast("string").alias("d"), "gap")


@query(f"""with {_DAYS} {_CAL} {_miss(4)}, j as (select m.d m, max(d.d) p from m join d on d.d between m.d-10 and m.d-1 group by 1)
select p::varchar prev, min(m)::varchar first_missing from j group by 1""")
def asof_prev(spark, sf):
    days = _days(spark, sf)
    return C.last_before(C.missing_days(days), days, 10).select(F.col("prev").cast("string").alias("prev"), F.col("first_missing").cast("string").alias("first_missing"))


@query(f"with {_DAYS[:-2]} select d::varchar d, lead(d) over (order by d)::varchar next_d from d")
def next_session(spark, sf):
    return C.with_next(_days(spark, sf)).select(F.col("d").cast("string").alias("d"), F.col("next_d").cast("string").alias("next_d"))


# The tables' hearings do not say when they adjourned; each is given a header and a last line from its own date.
_WRITTEN = "strftime(cast({0} as date),'%-d %B %Y')"
_HEARD = "h as (select session_id, try_cast(date_iso as date) d, session_id % 5 k from session_documents), "
_TARGET = "t as (select session_id, d, case when k < 3 then d + k::int + 1 end target, case when k < 3 then 'DATE' when k = 3 then 'OPEN' end kind from h where d is not null), "


def _spoken(spark, sf):
    """Whole texts of all hearings: session_id, d, text."""
    s = table(spark, sf, "session_documents").withColumn("d", F.try_to_date("date_iso", "yyyy-MM-dd"))
    k = F.pmod("session_id", F.lit(5)).cast("int")
    written = lambda c: F.date_format(c, "d MMMM yyyy")
    head = F.when(k % 2 == 0, F.concat(F.lit("Official transcript of the hearing held on "), written("d"), F.lit("\n"))).otherwise(F.concat(F.upper(F.date_format("d", "EEEE, d MMMM yyyy")), F.lit("\n")))
    end = F.when(k < 3, F.concat(F.lit(" The Tribunal adjourned until "), written(F.date_add("d", k + 1)), F.lit("."))).when(k == 3, F.lit(" The Tribunal will now adjourn."))
    said = F.array_join(F.transform("turns", lambda t: t["text"]), " ")
    return s.select("session_id", "d", F.concat(F.coalesce(head, F.lit("")), said, F.coalesce(end, F.lit(""))).alias("text"))


@query(f"with {_HEARD[:-2]} select session_id, d::varchar header_date from h")
def header_dates(spark, sf):
    return _spoken(spark, sf).select("session_id", dates.header_date(F.col("text")).cast("string").alias("header_date"))


@query(f"with {_HEARD} {_TARGET[:-2]} select session_id, target::varchar target, kind from t")
def adjournments(spark, sf):
    day, kind = dates.adjournment(F.col("text"))
    return _spoken(spark, sf).where("d is not null").select("session_id", day.cast("string").alias("target"), kind.alias("kind"))


@query(f"""with {_DAYS} {_RECESS} {_HEARD} {_TARGET} n as (select d, lead(d) over (order by d) next_d from d)
select t.session_id, t.d::varchar d, t.target::varchar target, n.next_d::varchar next_d, case when t.target is null then 'OPEN' when t.target=n.next_d then 'OK'
when t.target in (select d from rec) then 'OK' when t.target in (select d from d) then 'SKIPPED' else 'MISSING' end verdict
from t left join n on t.d=n.d""")
def crosscheck(spark, sf):
    found = C.cross_check(_targets(spark, sf), _days(spark, sf), _recess(spark))
    return found.select("session_id", *[F.col(c).cast("string").alias(c) for c in ("d", "target", "next_d")], "verdict")


def _targets(spark, sf):
    return _spoken(spark, sf).where("d is not null").select("session_id", "d", dates.adjournment(F.col("text"))[0].alias("target"))


@query(f"""with {_DAYS} {_RECESS} {_HEARD} {_TARGET} n as (select d, lead(d) over (order by d) next_d from d),
v as (select session_id, t.target is null or t.target=n.next_d or t.target in (select d from rec) ok from t left join n on t.d=n.d)
select case when ok then 'clean' else 'problem' end state, count(*) sessions from v group by 1""")
def session_states(spark, sf):
    found = C.cross_check(_targets(spark, sf), _days(spark, sf), _recess(spark))
    return found.groupBy(F.when(F.col("verdict").isin("OK", "OPEN"), "clean").otherwise("problem").alias("state")).agg(F.count(F.lit(1)).alias("sessions"))


@query(f"""with {_HEARD[:-2]} select session_id, d::varchar metadata_date, (d + case when session_id % 7 = 0 then 1 else 0 end)::varchar header_date
from h where session_id % 7 = 0 and d is not null""")
def date_conflicts(spark, sf):
    # every seventh header names the day after
    later = F.when(F.pmod("session_id", F.lit(7)) == 0, 1).otherwise(0)
    text = F.concat(F.lit("Tribunal sitting at the court house on "), F.date_format(F.date_add("d", later), "d MMMM yyyy"), F.lit(". "), "text")
    both = _spoken(spark, sf).where("d is not null").select("session_id", "d", dates.header_date(text).alias("h"))
    return both.where("h is not null and h != d").select("session_id", F.col("d").cast("string").alias("metadata_date"), F.col("h").cast("string").alias("header_date"))


@query(f"""with {_DAYS} {_CAL} w as (select d from cal where isodow(d)<=5), h as (select d from w where d in (select d from d))
select strftime(w.d,'%Y-%m') AS "month", count(h.d) have, count(*) total from w left join h on w.d=h.d group by 1""")
def month_coverage(spark, sf):
    days = _days(spark, sf)
    missing = C.missing_days(days).select("d", F.lit(0).alias("there"))
    held = days.where(F.weekday("d") <= 4).select("d", F.lit(1).alias("there"))
    return missing.unionByName(held).groupBy(F.date_format("d", "yyyy-MM").alias("month")).agg(F.sum("there").alias("have"), F.count(F.lit(1)).alias("total"))


@query("""with d as (select distinct cast(o_orderdate as date) d from orders), cal as (select unnest(generate_series((select min(d) from d),(select max(d) from d),interval 1 day))::date d),
m as (select d from cal where isodow(d)<=6 and d not in (select d from d)) select count(*) missing, coalesce(min(d)::varchar,'') first_day from m""")
def order_calendar(spark, sf):
    days = C.days_of(table(spark, sf, "orders"), F.col("o_orderdate"))
    return C.missing_days(days, 5).agg(F.count(F.lit(1)).alias("missing"), F.coalesce(F.min("d").cast("string"), F.lit("")).alias("first_day"))


def _text(df):
    return df.select(F.col("first_day").cast("string").alias("first_day"), F.col("last_day").cast("string").alias("last_day"), "n")


_FILED = "d as (select distinct cast(filed_on as date) d from documents where filed_on is not null), "


def _filed(spark, sf):
    return C.days_of(table(spark, sf, "documents"), F.col("filed_on"))


@query(f"with {_FILED} {_CAL} {_miss(4)}, {_island_sql('m', 3, 3)}")
def filing_islands(spark, sf):
    return _text(C.islands(C.missing_days(_filed(spark, sf)), gap=3, least=3))


@query(f"""with {_FILED} {_CAL} {_miss(5)}, k as (select d, row_number() over (order by d) k from cal where isodow(d)<=6),
g as (select k.d, k.k - row_number() over (order by k.d) g from k join m on k.d=m.d)
select min(d)::varchar first_day, max(d)::varchar last_day, count(*) n from g group by g having count(*)>=3""")
def filing_workday_islands(spark, sf):
    days = _filed(spark, sf)
    return _text(C.workday_islands(days, C.missing_days(days, 5), 5, 3))
