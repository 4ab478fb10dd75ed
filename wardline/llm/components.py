"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def components(links: DataFrame, *, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of ``links`` (columns ``a, b``, any orderable type): the smallest node
    reachable. Each step keeps at most as many links as there were and is written to the checkpoint folder,
    so a lost executor costs a step; the number of steps grows with the logarithm of the path lengths. Loops,
    repeated and reversed links are allowed; links with a null are ignored.
    """
    state = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    state = materialize(state)
    before = _digest(state)
    for _ in range(max_rounds):
        both = state.unionByName(state.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = materialize(large.where("a <> b").distinct())
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("low").alias("b")), F.struct("a", F.col("low").alias("b")))).alias("e"))
        state = materialize(small.select("e.a", "e.b").where("a <> b").distinct())
        after = _digest(state)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"links did not settle in {max_rounds} rounds")
    roots = state.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(state.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _digest(state: DataFrame):
    row = state.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("h")).first()
    return row["n"], row["h"]
