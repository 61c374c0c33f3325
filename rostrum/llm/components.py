"""Connected components of an edge table by alternating large and small stars.

Every step is a minimum per key (combined before the shuffle) and a join that
adaptive execution can split, so a node of very many edges is no bottleneck;
each round is written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostrum.llm.runtime import discard, materialise


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 40) -> DataFrame:
    """``id`` and ``component`` (the smallest id that can be reached) of every node that has an edge.

    Edges with a null end or with equal ends count as none; direction and
    repetition are of no matter; an empty table gives an empty one.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct()
    e = materialise(e, "edges")
    seen = _mark(e)
    for _ in range(rounds):
        if not seen[0]:
            break
        both = e.select(F.col("u").alias("x"), F.col("v").alias("y")).union(e.select(F.col("v").alias("x"), F.col("u").alias("y")))
        low = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.where("y > x").join(low, "x").select(F.col("y").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        before, e = e, materialise(
            small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).distinct(),
            "edges",
        )
        discard(before)
        now = _mark(e)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).union(e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def _mark(e: DataFrame) -> tuple:
    """Number of edges and a sum over their hashes: equal marks mean equal edges."""
    r = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return r.n, r.h
