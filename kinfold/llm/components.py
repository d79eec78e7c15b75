"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import written


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node with an edge; root is the smallest node of its component.

    Each round joins every edge to the smallest neighbour of its end (an aggregate that combines map-side),
    so a hub with very many edges is never held in one task, and the number of edges never grows. The number
    of rounds grows with the logarithm of the longest chain. Rounds are written to the checkpoint folder.
    Self-loops, repeated edges and NULL ends are ignored; an empty table gives an empty result.
    """
    def smaller_first(df: DataFrame) -> DataFrame:
        return df.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    cur = written(smaller_first(edges.select(F.col(a).alias("u"), F.col(b).alias("v"))))
    before = None
    for _ in range(max_rounds):
        # large star: every neighbour above u goes to the smallest of u and its neighbours
        both = cur.union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).withColumnRenamed("u", "x")
        large = cur.join(least, F.col("v") == F.col("x")).select("u", F.col("m").alias("v"))
        own = both.where("v > u").join(least, F.col("u") == F.col("x")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = smaller_first(large.union(own))
        # small star: u and its smaller neighbours go to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "x")
        small = large.join(low, F.col("u") == F.col("x")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        nxt = written(smaller_first(small.union(low.select(F.col("x").alias("u"), F.col("m").alias("v")))))
        # a few numbers describe the edge set; equal numbers twice mean that it no longer changes
        now = nxt.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        cur = nxt
        if now == before:
            return cur.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                cur.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
        before = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
