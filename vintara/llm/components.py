"""Connected components of an edge table, by alternating large and small stars.

Kiveris et al., "Connected Components in MapReduce and Beyond" (SoCC 2014). All state is
in DataFrames; each round is written to the shared folder, so no round grows the lineage
and nothing but two counters reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import durable, forget


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node of an edge, component being the smallest node reachable.

    Self loops, nulls and repeated edges are allowed and add nothing. An empty table gives an
    empty table. Hub nodes are safe: minima are aggregated map-side, and the join back to the
    edges is a plain equi join that AQE can split.
    """
    u, v = F.greatest(a, b), F.least(a, b)
    e, seen = _written(edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).select(u.alias("u"), v.alias("v")).distinct())
    for _ in range(max_rounds):
        if seen[0] == 0:
            break
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(down.select("u", F.col("m").alias("v"))).distinct()
        nxt, now = _written(small)
        forget(e)
        e = nxt
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _written(e: DataFrame) -> tuple[DataFrame, tuple[int, int]]:
    """``e`` written and read back, and the number and digest of its edges, told by the same pass."""
    seen = Observation()
    out = durable(e.observe(seen, F.count(F.lit(1)).alias("n"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0)).alias("x")), "cc")
    return out, (seen.get["n"], seen.get["x"])
