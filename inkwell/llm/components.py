"""Connected components of an edge table, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.sources.shared import materialise


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Of undirected ``edges(a, b)``: node, root, the smallest node of its component.

    Alternating large-star and small-star rounds (Kiveris et al., 2014): the number of edges never grows, the rounds are
    logarithmic, and a hub's neighbours are never gathered in one task: a round is an aggregate of minima and a join.
    Nulls and loops are left out. Each round is a table in the shared folder.
    """
    e = edges.select("a", "b").where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    e = materialise(e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where(F.col("a") != F.col("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where(F.col("a") != F.col("b"))
        e = materialise(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def pointer_roots(pointers: DataFrame) -> DataFrame:
    """Of ``pointers(node, to)`` without cycles, one a node at most: node, root, the end of its chain.

    Pointers are doubled three times a round, so a round reaches eight steps further; a round ends the work when no pointer
    leads to a node that points on. Each round is a table in the shared folder.
    """
    p = materialise(pointers.select("node", "to"))
    while True:
        for _ in range(3):
            p = p.join(p.select(F.col("node").alias("to"), F.col("to").alias("on")), "to", "left").select("node", F.coalesce("on", "to").alias("to"))
        p = materialise(p)
        if p.join(p.select(F.col("node").alias("to")), "to", "left_semi").isEmpty():
            return p.select("node", F.col("to").alias("root"))
