"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle

ROUNDS = 100


def components(edges: DataFrame) -> DataFrame:
    """(node, root): for every node of the edges (a, b) the smallest node that it reaches.

    Every round joins each node to the smallest neighbour (first of all its larger ones, then of its
    smaller ones), so paths shrink by halves. Minima are pre-aggregated where the edges lie; a hub is
    a skewed join key of narrow rows, never a gathered group. Rounds are cut by tables in the shared
    folder.
    """
    pairs = settle(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    for _ in range(ROUNDS):
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # Larger neighbours move to the smallest node around ...
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.unionByName(least.where("a <> m").select("a", F.col("m").alias("b"))).distinct()
        # ... and smaller ones too.
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(smallest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        pairs = settle(small.unionByName(smallest.select("a", F.col("m").alias("b"))).distinct())
        now = tuple(pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
    roots = pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
