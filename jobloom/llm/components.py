"""Connected components of a graph by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hot_rows, join_hot, stash


def _to_min(pairs: DataFrame, low: DataFrame, edges: int) -> DataFrame:
    """``pairs(u, v)`` with ``v`` linked to the least neighbour ``low(u, m, n)`` of ``u``; ``n`` counts the pairs of a ``u``.
    No join splits off hubs while the whole graph has too few edges for one."""
    hub = hot_rows(edges)
    near = pairs.join(low, "u") if edges < hub else join_hot(pairs, low, ["u"], F.col("n") >= hub)
    return near.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _large_star(pairs: DataFrame, edges: int) -> DataFrame:
    both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n"))
    return _to_min(both.where("v > u"), low, edges).where("u > v").distinct()


def _small_star(pairs: DataFrame, edges: int) -> DataFrame:
    low = pairs.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    own = low.select("u", F.col("m").alias("v"))
    return _to_min(pairs, low, edges).union(own).where("u > v").distinct()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges(u, v)`` of comparable ids -> ``(node, component)`` for every node with an edge.

    ``component`` is the smallest id reachable. Only the edge list moves, each round is a pair of
    grouped minima and joins written to the shared folder, and the driver sees three numbers a round.
    Self loops, repeated edges and null ends are ignored; an empty graph gives no rows.
    """
    low_first = F.least("u", "v").alias("v"), F.greatest("u", "v").alias("u")
    edges = stash(edges.where("u IS NOT NULL AND v IS NOT NULL AND u <> v").select(*low_first).distinct().select("u", "v"), "edges")
    before, n = None, edges.count()
    for _ in range(max_rounds):
        edges = stash(_small_star(_large_star(edges, n), n), "star")
        now = tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("v").cast("decimal(20,0)"))).first())
        if now == before:
            break
        before, n = now, now[0]
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
