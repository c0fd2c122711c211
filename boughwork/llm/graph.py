"""Connected components by alternating star contractions, one written table a round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boughwork.llm.common import discard, settle


def _digest(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")), F.lit(0))).first()
    return int(row[0]), int(row[1])


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for each node of an edge table ``(a, b)`` of longs.

    ``component`` is the smallest node reachable. Loops, repeated edges and either direction
    are fine; an edge with a null end is ignored; no edges give no rows. Each round is one
    large-star and one small-star contraction (O(log^2 n) rounds), joins and minima only, so a
    hub's neighbours are never gathered in one place.
    """
    current = settle(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a is not null and a <> b and b is not null")
        .distinct(),
        "edges",
    )
    before = _digest(current)
    for _ in range(max_rounds):
        if not before[0]:
            break
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = settle(large, "large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        old = current
        current = settle(small.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct(), "edges")
        discard(old, large)
        after = _digest(current)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = current.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
