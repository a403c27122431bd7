"""Connected components by alternating large and small stars; every step is a join and a partial minimum.

Minima are written before they meet their links again: the engine then knows their size, sends small ones to the links
and splits the many links of one vertex where they are large, so no vertex gathers its links in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framegauge.llm.common import discard, written


def _smallest(edges: DataFrame) -> DataFrame:
    return written(edges.groupBy("u").agg(F.min("v").alias("m")), "minima", per_core=2)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """``(id, component)`` for every id that an edge touches; component is the smallest id reachable.

    Self-links and repeated links are harmless; links with a null end are ignored; no links give no rows.
    Each round is written to the shared folder, and the one before it deleted. A round multiplies the reach of a link, so the number of rounds grows
    with the logarithm of the longest chain."""
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct()
    e, before = written(e, "cc", per_core=2), None
    for _ in range(rounds):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _smallest(both)
        large = written(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct(), "large", per_core=2)
        least2 = _smallest(large)
        small = large.join(least2, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u != v").distinct()
        new = written(small, "cc", per_core=2)
        discard(e, least, large, least2)
        e = new
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            roots = e.select(F.col("v").alias("id")).distinct()
            return e.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots.select("id", F.col("id").alias("component")))
        before = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")
