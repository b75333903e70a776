"""Aggregates and classes of the corpus audits.

Nulls: aggregates leave null values out, as SQL does; a null group key is a group; predicates on null are false unless
said otherwise. Empty tables give no group, and one row of zeros where a single row is the result.
"""

from __future__ import annotations

import functools

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

big = lambda c: c.cast("bigint")


def count_of(condition: Column, name: str) -> Column:
    """Rows that meet a condition, null counting as not met."""
    return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0)).cast("bigint").alias(name)


def shares(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows a group and its share of all rows (6 digits): keys, n, share."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(1))), 6))


def order_statistics(df: DataFrame, by: Sequence[str], value: str, points: dict[str, Sequence[int]]) -> DataFrame:
    """Values at index floor(n * a / b) of the sorted values of each group, for points name -> (a, b); nulls are left out.

    The position is found by a running count over distinct values, so a group's rows are never gathered in one task.
    """
    hist = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1))
    run = hist.withColumn("upto", F.sum("c").over(w.orderBy(value))).withColumn("n", F.sum("c").over(w))
    at = lambda a, b: F.floor(F.col("n") * a / b)
    picks = [F.max(F.when((F.col("upto") > at(a, b)) & (F.col("upto") - F.col("c") <= at(a, b)), F.col(value))).alias(k) for k, (a, b) in points.items()]
    return run.groupBy(*by).agg(F.max("n").alias("n"), *picks).where("n is not null")


def histogram(df: DataFrame, value: str, edges: Sequence[int]) -> DataFrame:
    """Rows a bucket: bucket 'a-b' between edges, the last 'a+'; nulls are in no bucket."""
    c, label = F.col(value), None
    for a, b in zip(edges, [*edges[1:], None]):
        name = f"{a}+" if b is None else (f"{a}" if b == a + 1 else f"{a}-{b - 1}")
        test = c >= a if b is None else (c >= a) & (c < b)
        label = F.when(test, name) if label is None else label.when(test, name)
    return df.select(label.alias("bucket")).where("bucket is not null").groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))


def boundary_class(tokens: Column) -> Column:
    """SHORT below 90 tokens, OK to 512, else OVERLONG; null for null."""
    return F.when(tokens < 90, "SHORT").when(tokens <= 512, "OK").when(tokens > 512, "OVERLONG")


def coverage_status(found: Column, target: Column) -> Column:
    """OK at the target, WARN at nine tenths, else SHORT; NO_TARGET without one."""
    return F.when(target.isNull(), "NO_TARGET").when(found >= target, "OK").when(found >= 0.9 * target, "WARN").otherwise("SHORT")


def first_rows(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], n: int) -> DataFrame:
    """The first ``n`` rows of each group in an order, with their place ``rk`` (from 1)."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("rk", F.row_number().over(w).cast("bigint")).where(F.col("rk") <= n)


def keep_first(df: DataFrame, by: Sequence[str], order: str) -> DataFrame:
    """One row a group: the one of the smallest ``order``, by an aggregate (no group is gathered or sorted)."""
    rest = [c for c in df.columns if c not in by and c != order]
    best = df.groupBy(*by).agg(F.min_by(F.struct(order, *rest), F.col(order)).alias("x"))
    return best.select(*by, "x.*")


def keep_last(df: DataFrame, by: Sequence[str], order: str) -> DataFrame:
    """One row a group: the one of the largest ``order``."""
    rest = [c for c in df.columns if c not in by and c != order]
    best = df.groupBy(*by).agg(F.max_by(F.struct(order, *rest), F.col(order)).alias("x"))
    return best.select(*by, "x.*")


def numbered(df: DataFrame, by: list[str], order: str, width: int = 1 << 16) -> DataFrame:
    """Rows with their place in their group (from 0, in the order of the whole-number column ``order``) and the group's rows:
    adds place, group_rows.

    A group is cut into stretches of ``width`` values of ``order``, which are numbered apart and shifted by the sizes of
    the stretches before; so a group of any size is spread over many tasks. Null keys are a group, null orders come first,
    ties are numbered in any order.
    """
    keyed = df.withColumn("_stretch", F.floor(F.col(order) / width))
    keys = [*by, "_stretch"]
    sizes = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    group = Window.partitionBy(*by)
    before = F.sum("_rows").over(group.orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1))
    shifts = sizes.select(*[F.col(k).alias(f"_s{i}") for i, k in enumerate(keys)], F.coalesce(before, F.lit(0)).alias("_before"), F.sum("_rows").over(group).alias("group_rows"))
    within = keyed.withColumn("_at", F.row_number().over(Window.partitionBy(*keys).orderBy(order)) - 1)
    same = [F.col(k).eqNullSafe(F.col(f"_s{i}")) for i, k in enumerate(keys)]
    joined = within.join(shifts, functools.reduce(lambda a, b: a & b, same))
    return joined.withColumn("place", F.col("_before") + F.col("_at")).drop("_stretch", "_at", "_before", *[f"_s{i}" for i in range(len(keys))])
