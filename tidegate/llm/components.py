"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import Scratch

#: Neighbours of one node are dealt to so many parts, for hubs.
SALTS = 16


def _nearest(e: DataFrame) -> DataFrame:
    """Edges (u, v) with m, the smallest of u and its neighbours.

    The minimum is combined before the shuffle; the join back is salted by the
    neighbour, so that a hub's edges don't meet in one task.
    """
    m = e.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    m = m.withColumn("s", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
    e = e.withColumn("s", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
    return e.join(m, ["u", "s"]).select("u", "v", "m")


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _nearest(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    """e has u > v."""
    n = _nearest(e)
    to_min = n.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("x"))
    return to_min.select("x.u", "x.v").where("u <> v").distinct()


def _state(e: DataFrame) -> tuple[int, int]:
    return tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(edges: DataFrame, scratch: Scratch, max_rounds: int = 100) -> DataFrame:
    """edges: two long columns. Returns a kept table (node, comp), comp the smallest node reachable.

    Nodes without an edge to another node don't appear; loops and repeated
    edges do no harm; null ends are ignored. An empty input gives an empty table.
    """
    a, b = edges.columns[:2]
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(f"{a} is not null and {b} is not null").where("u <> v").distinct()
    e = scratch.keep(e)
    before = _state(e)
    for _ in range(max_rounds):
        large = scratch.keep(_large_star(e))
        small = scratch.keep(_small_star(large))
        scratch.drop(e, large)
        e, now = small, _state(small)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    nodes = e.select(F.col("u").alias("node"), F.col("v").alias("comp")).union(e.select(F.col("v"), F.col("v")).distinct())
    out = scratch.keep(nodes)
    scratch.drop(e)
    return out
