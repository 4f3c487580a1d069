"""Connected components of an edge table by alternating star contraction (Kiveris et al., 2014).

Each round joins every edge with its node's smallest neighbour, which takes a number of
rounds logarithmic in the longest path.  Minima are aggregated before the shuffle, and the
edges of the few nodes with very many neighbours meet them by a broadcast of bounded size,
so such a node's edges stay where they are.  Rounds are written to the shared folder, so a
lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_heavy, written


def _large_star(e: DataFrame, n: int) -> DataFrame:
    both = e.union(e.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count("*").alias("c"))
    return join_heavy(both, least, "u", "c", 2 * n).where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(e: DataFrame, n: int) -> DataFrame:
    least = e.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("c"))
    moved = join_heavy(e, least, "a", "c", n).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def _size(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges`` (a long, b long) -> (node, root): each node on an edge and the smallest node it reaches.

    Self-loops, repeated edges and either direction are allowed; nulls are not.
    An empty table gives an empty result.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = written(e, "edges")
    before = _size(e)
    for _ in range(max_rounds):
        if not before[0]:
            break
        stars = written(_large_star(e, before[0]).distinct(), "stars")
        e = written(_small_star(stars, before[0]).distinct(), "edges")
        after = _size(e)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(e.select("b", "b").distinct())
