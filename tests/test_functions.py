from pyspark.sql import functions as F

from inkwell.functions import dates as D
from inkwell.functions import text as T


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(column.alias("x")).first().x


def test_tokens_slugs_hosts(spark):
    rows = spark.createDataFrame([("",), ("a" * 7,), ("a" * 8,), (None,)], "t string")
    assert [r.x for r in rows.select(T.offline_tokens(F.col("t")).alias("x")).collect()] == [1, 1, 2, None]
    url = "https://a.example/imt/01-02-46.asp#kalt"
    assert one(spark, T.slug_of(F.col("u")), u=url) == "01-02-46#kalt"
    assert one(spark, T.slug_of(F.col("u")), u="") == "unknown"
    assert one(spark, T.base_url(F.col("u")), u=url) == "https://a.example/imt/01-02-46.asp"
    assert one(spark, T.host_of(F.col("u")), u=url) == "a.example"
    assert one(spark, T.host_of(F.col("u")), u="no url") is None
    assert one(spark, T.file_name_of(F.col("u")), u="x/a b.asp/") == "a_b_asp"
    assert one(spark, T.word_count(F.col("u")), u=" a b  c ") == 3


def test_header_leaves_out_nulls_and_keeps_page_0(spark):
    none = F.lit(None).cast("string")
    got = T.context_header(none, F.lit("s"), none, F.lit("c"), F.lit(0))
    assert spark.range(1).select(got.alias("x")).first().x == "[Source: s | Collection: c | Page: 0]"


def test_dates(spark):
    say = lambda f, s: str(one(spark, f(F.col("t")), t=s))
    assert say(D.url_date, "/imt/01-02-46.asp") == "1946-01-02"
    assert say(D.url_date, "/imt/13-02-46.asp") == "None"
    assert say(D.file_date, "x_01-02-29") == "2029-01-02"
    assert say(D.written_date, "31 February 1946") == "None"
    assert say(D.written_date, "6 March 1946") == "1946-03-06"
    for said, iso in (("January 2, 1946", "1946-01-02"), ("2 Jan. 46", "1946-01-02"), ("2 Jan. '29", "2029-01-02"), ("", "None")):
        assert say(D.text_date, said) == iso
    day, kind = D.adjournment(F.col("t"))
    assert str(one(spark, day, t="adjourned until 3 May 1946. adjourned until Monday, 6 May 1946.")) == "1946-05-06"
    assert one(spark, kind, t="The tribunal adjourned sine die.") == "OPEN"
    assert one(spark, D.title_case(F.col("t")), t="TWO HUNDRED-SEVENTH") == "Two Hundred-Seventh"
