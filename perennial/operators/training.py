"""Training input: split, order, batches, sizes and class weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from perennial.operators.ranking import DEFAULT_SEED, mark_share, share_size, with_position


def split(
    examples: DataFrame, key: str, validation: float = 0.2, seed: int = DEFAULT_SEED
) -> DataFrame:
    """Add ``part``: exactly ``int(n * validation)`` rows are ``val``, the rest ``train``."""
    marked = mark_share(examples, key, validation, seed=seed)
    return marked.withColumn(
        "part", F.when(F.col("taken"), F.lit("val")).otherwise(F.lit("train"))
    ).drop("taken")


def split_sizes(size: DataFrame, validation: float = 0.2, batch: int = 32) -> DataFrame:
    """Sizes that follow from the dataset size alone."""
    val = share_size(F.col("dataset_size"), validation)
    sized = size.select("dataset_size", val.alias("val_size")).withColumn(
        "train_size", F.col("dataset_size") - F.col("val_size")
    )
    return sized.withColumn(
        "steps_per_epoch", F.floor(F.col("train_size") / batch).cast("bigint")
    ).withColumn("validation_steps", F.floor(F.col("val_size") / batch).cast("bigint"))


def shuffled(examples: DataFrame, key: str, seed: int = DEFAULT_SEED) -> DataFrame:
    """Give every example its place in the seeded order."""
    return with_position(examples, key, seed)


def batched(positions: DataFrame, batch: int = 32) -> DataFrame:
    """Number the batches; the last one holds the remainder."""
    return positions.withColumn(
        "batch_id", F.floor((F.col("position") - 1) / batch).cast("bigint")
    )


def class_weights(label_counts: DataFrame, label_map: DataFrame) -> DataFrame:
    """Inverse frequency per id of the vocabulary, largest weight 1.

    ``label_counts`` is ``(label_id, n)``. The total counts every label, also
    one outside the vocabulary; a class without examples counts as one. Without
    any example the weights are null. An empty vocabulary is an error.
    """
    ids = label_map.select("label_id").distinct()
    joined = ids.join(label_counts.select("label_id", "n"), "label_id", "left")
    total = label_counts.agg(F.sum("n")).scalar()
    everything = Window.partitionBy(F.lit(0))
    raw = joined.select(
        "label_id",
        (total / (F.count("*").over(everything) * F.coalesce(F.col("n"), F.lit(1)))).alias("raw"),
    )
    return raw.select("label_id", (F.col("raw") / F.max("raw").over(everything)).alias("weight"))


def require_vocabulary(label_map: DataFrame) -> DataFrame:
    if label_map.isEmpty():
        raise ValueError("the label map is empty")
    return label_map
