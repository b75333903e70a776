import datetime as dt

from pyspark.sql import functions as F

from inkwell.operators import audit as A
from inkwell.operators import calendar as C


def days(spark, *iso):
    return spark.createDataFrame([(dt.date.fromisoformat(x),) for x in iso], "d date")


def test_order_statistics_are_values_at_an_index(spark):
    df = spark.createDataFrame([(x,) for x in [*range(1, 11), None]], "v int")
    r = A.order_statistics(df, [], "v", {"p25": (1, 4), "median": (1, 2), "p75": (3, 4), "p90": (9, 10)}).first()
    assert (r.p25, r.median, r.p75, r.p90, r.n) == (3, 6, 8, 10, 10)
    assert A.order_statistics(df.where("v > 99"), [], "v", {"m": (1, 2)}).count() == 0


def test_histogram_and_classes(spark):
    df = spark.createDataFrame([(x,) for x in (0, 127, 128, 512, 768, None, -3)], "v int")
    got = {r.bucket: r.n for r in A.histogram(df, "v", [0, 1, 128, 256, 512, 768]).collect()}
    assert got == {"0": 1, "1-127": 1, "128-255": 1, "512-767": 1, "768+": 1}
    cls = spark.createDataFrame([(x,) for x in (89, 90, 512, 513, None)], "t int").select(A.boundary_class(F.col("t")).alias("c"))
    assert [r.c for r in cls.collect()] == ["SHORT", "OK", "OK", "OVERLONG", None]
    cov = spark.createDataFrame([(12, 12), (11, 12), (10, 12), (1, None)], "f int, t int").select(A.coverage_status(F.col("f"), F.col("t")).alias("c"))
    assert [r.c for r in cov.collect()] == ["OK", "WARN", "SHORT", "NO_TARGET"]


def test_keep_first_last_and_ties(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, None), (None, 1, "z")], "k string, o int, v string")
    assert {(r.k, r.v) for r in A.keep_first(df, ["k"], "o").collect()} == {("a", "y"), ("b", None), (None, "z")}
    assert {(r.k, r.v) for r in A.keep_last(df, ["k"], "o").collect()} == {("a", "x"), ("b", None), (None, "z")}
    assert A.first_rows(df, ["k"], ["o"], 1).count() == 3


def test_islands_and_as_of(spark):
    missing = days(spark, "1946-04-17", "1946-04-18", "1946-04-19", "1946-04-22", "1946-04-23", "1946-04-29")
    assert [(str(r.first_day), str(r.last_day), r.n) for r in C.islands(missing, 3, 3).collect()] == [("1946-04-17", "1946-04-23", 5)]
    asof = C.last_before(days(spark, "1946-04-19", "1946-04-22", "1946-05-01"), days(spark, "1946-04-18"), 10)
    assert [(str(r.prev), str(r.first_missing)) for r in asof.collect()] == [("1946-04-18", "1946-04-19")]
    assert C.missing_days(days(spark, "1945-11-14", "1946-10-01")).count() == 230 - 2
    assert C.missing_days(days(spark, "1945-11-14", "1946-10-01"), 5).count() == 276 - 2
    assert C.missing_days(days(spark).where("false")).count() == 0


def test_cross_check(spark):
    held = days(spark, "1946-01-01", "1946-01-02", "1946-01-05", "1946-01-09")
    d = dt.date.fromisoformat
    rows = [("1946-01-01", "1946-01-02"), ("1946-01-02", "1946-01-09"), ("1946-01-05", "1946-02-02"), ("1946-01-09", None), ("1946-01-01", "1946-03-03")]
    targets = spark.createDataFrame([(d(a), b and d(b)) for a, b in rows], "d date, target date")
    got = {(str(r.d), str(r.target)): r.verdict for r in C.cross_check(targets, held, days(spark, "1946-02-02")).collect()}
    assert [got[a, str(b)] for a, b in rows] == ["OK", "SKIPPED", "OK", "OPEN", "MISSING"]


def test_hot_groups_are_numbered_in_stretches(spark):
    from inkwell.operators import audit

    rows = [("a", i * 3) for i in range(200)] + [("b", 7), (None, 5), (None, 9)]
    got = audit.numbered(spark.createDataFrame(rows, "g string, place long").withColumnRenamed("place", "at"), ["g"], "at", width=50).collect()
    assert sorted((r.at, r.place, r.group_rows) for r in got if r.g == "a") == [(3 * i, i, 200) for i in range(200)]
    assert sorted((r.at, r.place, r.group_rows) for r in got if r.g is None) == [(5, 0, 2), (9, 1, 2)]
