"""Champion and challenger: who wins, and what the next state is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perennial.functions import versions

# Names of the services a decision updates.
CHAMPION_SERVICE = "champion-service"
CHALLENGER_SERVICE = "challenger-service"


def evaluate(state: DataFrame, scores: DataFrame) -> DataFrame:
    """Scores of both versions and the winner.

    ``state`` is one row ``(champion, challenger)``. A version without a score
    counts as 0; the challenger has to be strictly better.
    """
    roles = state.select(
        "champion",
        "challenger",
        F.explode(F.array("champion", "challenger")).alias("model_version"),
    )
    scored = roles.join(scores, "model_version", "left")

    def score_of(role: str) -> Column:
        mine = F.when(F.col("model_version") == F.col(role), F.col("avg_prediction_accuracy"))
        return F.coalesce(F.max(mine), F.lit(0.0)).alias(f"{role}_score")

    return (
        scored.groupBy("champion", "challenger")
        .agg(score_of("champion"), score_of("challenger"))
        .withColumn(
            "winner",
            F.when(F.col("challenger_score") > F.col("champion_score"), F.col("challenger")).otherwise(
                F.col("champion")
            ),
        )
    )


def step(evaluated: DataFrame) -> DataFrame:
    """The next champion and challenger, the service to update and the version it had."""
    promoted = F.col("winner") != F.col("champion")
    return evaluated.select(
        "winner",
        F.col("winner").alias("champion_version"),
        versions.next_version(F.col("challenger")).alias("challenger_version"),
        F.when(promoted, F.lit(CHAMPION_SERVICE))
        .otherwise(F.lit(CHALLENGER_SERVICE))
        .alias("service_to_update"),
        F.when(promoted, F.col("winner")).otherwise(F.col("challenger")).alias("previous_model_version"),
    )


def next_state(stepped: DataFrame, current: DataFrame, deployed_at: str) -> DataFrame:
    """State document after a step: a kept champion keeps its deployment time.

    ``current`` is the one-row state with the structs ``champion`` and ``challenger``.
    """
    pair = stepped.join(
        current.select(
            F.col("champion.model_version").alias("old_version"),
            F.col("champion.deployed_at").alias("old_time"),
        ),
        F.col("champion_version") == F.col("old_version"),
        "left",
    )
    return pair.select(
        F.struct(
            F.col("champion_version").alias("model_version"),
            F.when(F.col("old_version").isNull(), F.lit(deployed_at))
            .otherwise(F.col("old_time"))
            .alias("deployed_at"),
        ).alias("champion"),
        F.struct(
            F.col("challenger_version").alias("model_version"),
            F.lit(None).cast("string").alias("deployed_at"),
        ).alias("challenger"),
    )
