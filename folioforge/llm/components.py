"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.store import table


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """(node, class): the smallest node of each node's component, for all nodes of ``edges`` (a, b).

    Each round links every node to the smallest neighbour (large star, then small star), so a component of m nodes takes
    about log m rounds. Neighbours are pre-aggregated by min; no component is collected. Self-loops and repeated edges do
    not matter; an empty table gives an empty result.
    """
    now = table(edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL").distinct())
    before = None
    for _ in range(rounds):
        both = now.select("a", "b").unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(least.where("m < a").select("a", F.col("m").alias("b"))).distinct()
        down = large.where("b < a").groupBy("a").agg(F.min("b").alias("m"))
        small = large.where("b < a").join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").unionAll(down.select("a", F.col("m").alias("b"))).distinct()
        now = table(small)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    found = now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("class"))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("class")).distinct()
    alone = edges.where("a = b").select(F.col("a").alias("node"), F.col("a").alias("class")).distinct()
    return found.unionAll(roots).unionAll(alone).groupBy("node").agg(F.min("class").alias("class"))
