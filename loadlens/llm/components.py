"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm.common import cut


def components(edges: DataFrame, most_rounds: int = 50) -> DataFrame:
    """(node, root) for every node of edges (a long, b long); root is the component's least node.

    Each round hangs every node's larger neighbours, then its smaller ones, on
    its least neighbour.  Links never leave the executors: only their count and
    a checksum come back, to see whether a round changed anything.  Every round
    is written to the shared checkpoint folder, so a lost executor costs one round.
    """
    now = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    state = _state(now)
    for _ in range(most_rounds):
        if not state[0]:
            break
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(least.select("a", F.col("m").alias("b")))
                 .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
        now = cut(small)
        was, state = state, _state(now)
        if was == state:
            break
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return now.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root").union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]
