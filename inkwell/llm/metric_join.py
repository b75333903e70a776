"""Exact radius joins of strings under the edit distance, by metric-space partitioning."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.sources.shared import materialise

#: Pivots are about twice the square root of the number of strings, and no more than this; they are literals of the plan.
MAX_PIVOTS = 256


def edits(a: str, b: str) -> int:
    """The edit distance, a column of the table held in the bits of three integers (Myers, 1999)."""
    if not a or not b:
        return len(a) + len(b)
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    mask, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, d = mask, 0, len(a)
    for c in b:
        m = where.get(c, 0)
        x = m | down
        h = (((m & up) + up) ^ up) | m
        more, less = down | ~(h | up) & mask, up & h
        d += bool(more & top) - bool(less & top)
        more, less = (more << 1 | 1) & mask, less << 1 & mask
        up, down = less | ~(x | more) & mask, more & x
    return d


def far_apart(candidates: list[str], n: int, apart: int) -> list[str]:
    """The first ``n`` of the candidates, in their order, that are more than ``apart`` from those taken before."""
    taken: list[str] = []
    for s in candidates:
        if len(taken) == n:
            break
        if all(abs(len(s) - len(t)) > apart or edits(s, t) > apart for t in taken):
            taken.append(s)
    return taken


def radius_pairs(strings: DataFrame, column: str, radius: int, max_pivots: int = MAX_PIVOTS, weight: str | None = None) -> DataFrame:
    """All pairs of different values of ``column`` within ``radius`` edits: x < y, distance. Exact, whatever the pivots.

    Pivots are far apart, the heaviest strings first: around a frequent spelling its misspellings lie close. A string lives
    in the cell of its nearest pivot, there on the ring of its distance to it. By the triangle inequality a partner lies at
    most twice the radius farther from that pivot than from its own nearest one, and its distance to the pivot differs from
    the ring by the radius at most: it is sent to those rings only. On a ring strings of nearly equal length meet whose
    distances to all pivots differ by the radius at most; only these are compared. Nulls are left out, repeated values
    count once.
    """
    heavy = F.lit(1) if weight is None else F.col(weight)
    values = strings.select(F.col(column).alias("s"), heavy.alias("w")).where("s is not null").groupBy("s").agg(F.sum("w").alias("w"))
    total = values.count()
    wanted = max(1, min(max_pivots, 2 * math.isqrt(total)))
    # four candidates a pivot: a bounded number
    candidates = [r.s for r in values.orderBy(F.desc("w"), F.xxhash64("s"), "s").limit(4 * wanted).collect()]
    pivots = far_apart(candidates, wanted, 2 * radius)
    if not pivots:
        return values.select(F.col("s").alias("x"), F.col("s").alias("y"), F.lit(0).alias("distance"))
    placed = values.withColumn("d", F.array(*[F.levenshtein(F.col("s"), F.lit(p)).cast("short") for p in pivots]))
    placed = materialise(placed.select("s", "d", F.array_min("d").alias("low"), F.length("s").alias("len")))
    home = placed.select(
        F.col("s").alias("x"), F.col("d").alias("dx"), (F.array_position("d", F.col("low")) - 1).cast("int").alias("cell"), F.col("low").cast("int").alias("ring"), "len"
    )
    # rings that are there: at most pivots times the longest string
    rings = home.groupBy("cell", "ring", "len").agg(F.lit(1).alias("there"))
    reach = F.posexplode(F.transform("d", lambda d: F.when(d <= F.col("low") + 2 * radius, d.cast("int")))).alias("cell", "at")
    sent = placed.select(F.col("s").alias("y"), F.col("d").alias("dy"), F.col("len").alias("len_y"), reach).where("at is not null")
    steps = F.sequence(F.lit(-radius), F.lit(radius))
    sent = sent.select("y", "dy", "cell", "at", "len_y", F.explode(steps).alias("i")).select("y", "dy", "cell", (F.col("at") + F.col("i")).alias("ring"), "len_y", F.explode(steps).alias("j"))
    sent = sent.select("y", "dy", "cell", "ring", (F.col("len_y") + F.col("j")).alias("len")).join(rings, ["cell", "ring", "len"]).drop("there")
    met = home.join(sent, ["cell", "ring", "len"]).where(
        (F.col("x") != F.col("y")) & F.forall(F.zip_with("dx", "dy", lambda a, b: F.abs(a - b) <= radius), lambda ok: ok)
    )
    # x lives on one ring only, so each ordered pair is made once
    return met.withColumn("distance", F.levenshtein("x", "y", radius)).where("distance >= 0 and x < y").select("x", "y", "distance")
