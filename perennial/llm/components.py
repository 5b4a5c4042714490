"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perennial.session import stage

_LIMIT = 100


def _lowest(pairs: DataFrame) -> DataFrame:
    """For each ``u`` the smaller of itself and its smallest neighbour."""
    return pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))


def large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of node and neighbours."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (
        both.where("v > u")
        .join(_lowest(both), "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .where("u <> v")
        .distinct()
    )


def small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(u, v)`` links to ``(node, component)``: the smallest node reachable, for every linked node.

    Loops and null ends are dropped, repeated links count once, no links give
    an empty table. A node with very many links is a key that meets its own
    minimum, which adaptive execution splits; only counts reach the driver.
    Every step is a written table, so a lost executor repeats one step.
    """
    stars = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    stars = stage(stars, "components")
    before = None
    for _ in range(_LIMIT):
        n, digest = stars.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if not n or (n, digest) == before:
            break
        before = (n, digest)
        stars = stage(small_star(large_star(stars)), "components")
    else:
        raise RuntimeError("components did not settle")
    linked = stars.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return linked.union(roots)
