"""Exact ranks, shares and positions by a seeded hash, without a single-task sort.

Rows are ordered by ``md5(seed|key)``, then key. The first hex digits of the
hash cut that order into consecutive ranges of about equal size, so counts per
range give every range its offset and only rows of one range are ever sorted
together. The order depends on seed and key alone, not on partitioning, retries
or cluster size. ``key`` is meant to be an object path, which is unique in a
store; repeated keys are still ranked one by one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perennial.session import stage

# 4,096 ranges per group find a cut: few enough for counting to shrink the data on
# the map side. Positions sort every range, so they use 65,536 smaller ones.
CUT_DIGITS = 3
POSITION_DIGITS = 4
DEFAULT_SEED = 42


def seeded_hash(key: Column, seed: int = DEFAULT_SEED) -> Column:
    """A null key is hashed as the empty text, and ranks before it."""
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(key.cast("string"), F.lit(""))))


def _with_range(df: DataFrame, key: str, seed: int, digits: int) -> DataFrame:
    hashed = df.withColumn("hash_", seeded_hash(F.col(key), seed))
    return hashed.withColumn("range_", F.substring("hash_", 1, digits))


def share_size(total: Column, fraction: float) -> Column:
    """``int(total * fraction)`` in double arithmetic."""
    return F.floor(total * F.lit(float(fraction))).cast("bigint")


def _cut_points(hashed: DataFrame, fraction: float, by: Sequence[str]) -> DataFrame:
    """Per group: the range in which the share ends and how many of its rows belong.

    The windows run over at most 4,096 counted rows per group.
    """
    group = [F.col(c) for c in by] or [F.lit(0)]
    counts = hashed.groupBy(*by, "range_").agg(F.count("*").alias("n"))
    whole = Window.partitionBy(*group)
    running = whole.orderBy("range_").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        counts.withColumn("upto", F.sum("n").over(running))
        .withColumn("size_", share_size(F.sum("n").over(whole), fraction))
        .withColumn("before", F.col("upto") - F.col("n"))
    )
    return placed.filter((F.col("before") <= F.col("size_")) & (F.col("upto") > F.col("size_"))).select(
        *by, F.col("range_").alias("cut_"), (F.col("size_") - F.col("before")).alias("need_")
    )


def mark_share(
    df: DataFrame,
    key: str,
    fraction: float,
    by: Sequence[str] = (),
    seed: int = DEFAULT_SEED,
    flag: str = "taken",
) -> DataFrame:
    """Flag exactly ``int(n * fraction)`` rows of every group.

    Rows outside the range of the cut are decided by a comparison, without a
    shuffle; only the rows of that one range, about 1 in 4,096, are sorted.
    The input is read three times, so stage it first when it is costly.
    """
    if not 0 <= fraction < 1:
        raise ValueError("fraction must be in [0, 1)")
    hashed = _with_range(df, key, seed, CUT_DIGITS)
    if by:
        cuts = stage(_cut_points(hashed, fraction, by), "cut-points")
        cut_rows = hashed.join(cuts, list(by))
    else:
        cut = _cut_points(hashed, fraction, by)
        only = cut.select(F.struct("cut_", "need_")).scalar()
        cut_rows = hashed.withColumn("only_", only).select(
            "*", F.col("only_.cut_").alias("cut_"), F.col("only_.need_").alias("need_")
        )
    decided = cut_rows.filter(F.col("range_") != F.col("cut_")).withColumn(
        flag, F.col("range_") < F.col("cut_")
    )
    order = Window.partitionBy(*by, "range_").orderBy("hash_", key)
    at_cut = cut_rows.filter(F.col("range_") == F.col("cut_")).withColumn(
        flag, F.row_number().over(order) <= F.col("need_")
    )
    keep = [*df.columns, flag]
    return decided.select(*keep).unionByName(at_cut.select(*keep))


def with_position(
    df: DataFrame, key: str, seed: int = DEFAULT_SEED, name: str = "position"
) -> DataFrame:
    """Add the 1-based rank of every row in the seeded order.

    The offsets are at most 65,536 rows by construction, hence the broadcast.
    """
    hashed = _with_range(df, key, seed, POSITION_DIGITS)
    counts = hashed.groupBy("range_").agg(F.count("*").alias("n"))
    running = Window.partitionBy(F.lit(0)).orderBy("range_")
    offsets = counts.select(
        "range_",
        (F.sum("n").over(running.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias(
            "before_"
        ),
    )
    inside = Window.partitionBy("range_").orderBy("hash_", key)
    return (
        hashed.withColumn("row_", F.row_number().over(inside))
        .join(F.broadcast(offsets), "range_")
        .withColumn(name, F.col("before_") + F.col("row_"))
        .select(*df.columns, name)
    )
