"""Calendars: missing days, gaps and islands, as-of look-back, next session.

Dates are day values; null dates are left out. A session on a day that occurs twice counts once. Empty input gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def days_of(df: DataFrame, date: Column) -> DataFrame:
    """Distinct days: d."""
    return df.select(date.cast("date").alias("d")).where("d is not null").distinct()


def missing_days(days: DataFrame, last_weekday: int = 4, recess: DataFrame | None = None) -> DataFrame:
    """Weekdays (0 Monday to ``last_weekday``) between the first and the last day that are not among the days: d.

    The calendar has a row a day, whatever the corpus; days of ``recess(d)`` are left out.
    """
    span = days.agg(F.min("d").alias("a"), F.max("d").alias("b")).where("a is not null")
    calendar = span.select(F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("d"))
    gone = calendar.where(F.weekday("d") <= last_weekday).join(days, "d", "left_anti")
    return gone.join(recess.select("d"), "d", "left_anti") if recess is not None else gone


def islands(days: DataFrame, gap: int, least: int) -> DataFrame:
    """Runs of days at most ``gap`` days apart, of at least ``least`` days: first_day, last_day, n.

    One window without a key: its rows are days of a calendar, some hundreds a year, not rows of the corpus.
    """
    w = Window.partitionBy(F.lit(1)).orderBy("d")
    new = F.when(F.datediff("d", F.lag("d").over(w)) <= gap, 0).otherwise(1)
    numbered = days.withColumn("new", new).withColumn("run", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    runs = numbered.groupBy("run").agg(F.min("d").alias("first_day"), F.max("d").alias("last_day"), F.count(F.lit(1)).alias("n"))
    return runs.where(F.col("n") >= least).drop("run")


def workday_islands(days: DataFrame, missing: DataFrame, last_weekday: int, least: int) -> DataFrame:
    """Runs of missing days that follow each other in the series of weekdays: first_day, last_day, n."""
    w = Window.partitionBy(F.lit(1)).orderBy("d")
    span = days.agg(F.min("d").alias("a"), F.max("d").alias("b")).where("a is not null")
    calendar = span.select(F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("d")).where(F.weekday("d") <= last_weekday)
    at = calendar.withColumn("k", F.row_number().over(w)).join(missing, "d")
    run = at.withColumn("run", F.col("k") - F.row_number().over(w))
    return (
        run.groupBy("run").agg(F.min("d").alias("first_day"), F.max("d").alias("last_day"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= least).drop("run")
    )


def last_before(missing: DataFrame, days: DataFrame, back: int) -> DataFrame:
    """The last session day before each missing day, at most ``back`` days before it, and of each session day only the
    first such missing day: prev, first_missing. By union and a carried-forward value, not by a range join."""
    both = missing.select("d", F.lit(1).alias("m")).unionByName(days.select("d", F.lit(0).alias("m")))
    w = Window.partitionBy(F.lit(1)).orderBy("d", "m").rowsBetween(Window.unboundedPreceding, 0)
    seen = both.withColumn("prev", F.last(F.when(F.col("m") == 0, F.col("d")), ignorenulls=True).over(w)).where("m = 1")
    return seen.where(F.datediff("d", "prev") <= back).groupBy("prev").agg(F.min("d").alias("first_missing"))


def with_next(days: DataFrame) -> DataFrame:
    """Each day with the next one (null for the last): d, next_d."""
    return days.withColumn("next_d", F.lead("d").over(Window.partitionBy(F.lit(1)).orderBy("d")))


def cross_check(targets: DataFrame, days: DataFrame, recess: DataFrame) -> DataFrame:
    """Where a session adjourned to (``targets(d, target)``): OK if that is the next session or in recess, SKIPPED if a
    later session, MISSING if none, OPEN without a target. Adds next_d and verdict."""
    near = targets.join(with_next(days), "d", "left")
    known = days.select(F.col("d").alias("target"), F.lit(1).alias("there"))
    off = recess.select(F.col("d").alias("target"), F.lit(1).alias("off")).distinct()
    verdict = (
        F.when(F.col("target").isNull(), "OPEN")
        .when(F.col("target") == F.col("next_d"), "OK")
        .when(F.col("off") == 1, "OK")
        .when(F.col("there") == 1, "SKIPPED")
        .otherwise("MISSING")
    )
    return near.join(known, "target", "left").join(off, "target", "left").withColumn("verdict", verdict).drop("there", "off")
