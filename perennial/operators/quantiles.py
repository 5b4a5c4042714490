"""Exact percentiles per group in bounded memory."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perennial.operators.joins import join_groups
from perennial.session import stage

ACCURACY = 10_000
# A bracket reaches so many times the sketch's error, and so many ranks, to either side of
# its percentile: five of both. The sketch is asked for margins that double from the least.
SAFETY = 5
LEAST = SAFETY / ACCURACY
MARGINS = [LEAST * 2**k for k in range(11)]


# Values of a group that the built-in exact aggregate may hold. Larger groups are bracketed.
HELD = 50_000
# Value ranges into which a bracket is split before its values are sorted.
CELLS = 256


def exact_percentiles(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    points: dict[str, float],
    also: Sequence[Column] = (),
    held: int = HELD,
) -> DataFrame:
    """Interpolated percentiles of ``value``, one column per entry of ``points``.

    ``also`` are named aggregates of the groups, computed along with the counts.
    With them every group is in the result, with null percentiles if it has no
    value; without them such groups are left out.

    The built-in exact aggregate keeps every distinct value of a group in one
    buffer, so it is used for groups of up to ``held`` values only. Larger ones
    are few; their percentiles are bracketed by a mergeable sketch first, whose
    width follows from the sketch's error and the group's size, so that it
    cannot miss.
    """
    by = list(by)
    groups = stage(df.groupBy(*by).agg(F.count(value).alias("n_"), *also), "percentile-groups")
    present = df.filter(F.col(value).isNotNull()).select(*by, F.col(value).alias("v"))
    large = groups.where(F.col("n_") > held).select(*by)
    exact = [F.percentile("v", float(p)).alias(name) for name, p in points.items()]
    if large.isEmpty():
        found = present.groupBy(*by).agg(*exact)
    else:
        marked = join_groups(present, large.withColumn("large_", F.lit(True)), by, "left")
        small = marked.where("large_ is null").groupBy(*by).agg(*exact)
        found = small.unionByName(_bracketed(marked.where("large_").drop("large_"), by, points))
    shown = groups if also else groups.where("n_ > 0")
    return join_groups(shown.drop("n_"), found, by, "left")


def _bracketed(present: DataFrame, by: list[str], points: dict[str, float]) -> DataFrame:
    """Percentiles of large groups of values ``v``: by sketch, then among the values of a bracket.

    A second read counts what lies below the brackets and, in them, how many
    values each of ``CELLS`` ranges holds. Only the values of the ranges in
    which a percentile falls are put in order, so no task sorts a whole bracket.
    """
    edges = [
        min(1.0, max(0.0, p + side * margin))
        for p in points.values()
        for margin in MARGINS
        for side in (-1, 1)
    ]
    groups = stage(
        present.groupBy(*by).agg(
            F.count("v").alias("n_"), F.percentile_approx("v", edges, ACCURACY).alias("edges_")
        ),
        "percentile-sketches",
    )

    def bracket(i: int, name: str, p: float) -> Column:
        # the first margin that holds SAFETY ranks of the group; the last one holds all of any
        steps = F.ceil(F.log2(F.greatest(F.lit(SAFETY) / F.col("n_"), F.lit(LEAST)) / F.lit(LEAST)))
        first = 2 * (i * len(MARGINS) + F.least(steps, F.lit(len(MARGINS) - 1)).cast("int"))

        def edge(place: int) -> Column:
            return F.get("edges_", first + place)

        return F.struct(
            F.lit(name).alias("point"),
            (F.lit(float(p)) * (F.col("n_") - 1)).alias("at"),
            edge(0).alias("low"),
            edge(1).alias("high"),
        )

    found = [bracket(i, name, p) for i, (name, p) in enumerate(points.items())]
    brackets = stage(groups.select(*by, F.inline(F.array(*found))), "percentile-brackets")
    key = [*by, "point", "at"]
    within = (F.col("v") - F.col("low")) / (F.col("high") - F.col("low"))
    cell = F.when(F.col("v") < F.col("low"), -1).otherwise(
        F.least(F.coalesce(F.floor(within * CELLS), F.lit(0)), F.lit(CELLS - 1))
    )
    # the first edge's values and below it are cell -1 and 0; equal edges are one cell
    seen = (
        join_groups(present, brackets, by)
        .filter(F.col("v") <= F.col("high"))
        .withColumn("cell", F.when(F.col("high") > F.col("low"), cell).otherwise(F.when(F.col("v") < F.col("low"), -1).otherwise(0)).cast("int"))
    )
    counts = seen.groupBy(*key, "cell").agg(F.count("*").alias("c"))
    up = Window.partitionBy(*key).orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    placed = counts.withColumn("upto", F.sum("c").over(up)).withColumn("before", F.col("upto") - F.col("c"))
    low, high = F.floor("at"), F.ceil("at")
    holds = lambda rank: (F.col("before") <= rank) & (rank < F.col("upto"))
    wanted = stage(
        placed.where((F.col("cell") >= 0) & (holds(low) | holds(high))).select(*key, "cell", "before"), "percentile-cells"
    )
    # equal values collapse before the shuffle
    values = join_groups(seen.select(*key, "cell", "v"), wanted, [*key, "cell"]).groupBy(*key, "cell", "before", "v").agg(
        F.count("*").alias("c")
    )
    inside = Window.partitionBy(*key, "cell").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ordered = values.withColumn("upto", F.col("before") + F.sum("c").over(inside)).withColumn("start", F.col("upto") - F.col("c"))

    def value_at(rank: Column) -> Column:
        return F.max(F.when((F.col("start") <= rank) & (rank < F.col("upto")), F.col("v")))

    picked = ordered.groupBy(*key).agg(value_at(low).alias("lower"), value_at(high).alias("upper"))
    blend = F.when(
        F.col("lower").isNotNull() & F.col("upper").isNotNull(),
        F.col("lower") + (F.col("at") - F.floor("at")) * (F.col("upper") - F.col("lower")),
    ).otherwise(F.raise_error(F.lit("percentile outside its bracket")).cast("double"))
    valued = picked.withColumn("x", blend)
    return valued.groupBy(*by).agg(
        *[F.max(F.when(F.col("point") == name, F.col("x"))).alias(name) for name in points]
    )
