"""Connected components of an edge table, by alternating large and small star
steps; nothing is brought to the driver but two numbers a round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entiscore.llm.tables import discard, stored


def _mark(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return r["n"], r["s"]


def connected(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node of an edge (long columns): root is the
    smallest node of its component. Loops and repeated edges do no harm; an
    empty edge table gives an empty result. The result is stored."""
    now = stored(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u IS NOT NULL AND v IS NOT NULL AND u <> v")
                 .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = _mark(now)
    while True:
        # Large star: every larger neighbour goes to the least of the neighbourhood.
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: every smaller neighbour, and the node, to the least of them.
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        step = large.join(small, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        last, now = now, stored(step.filter("u <> v").distinct(), "edges")
        discard(last)
        new = _mark(now)
        if new == mark:
            break
        mark = new
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
