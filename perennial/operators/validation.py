"""Reports on a stored dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from perennial.operators import vocabulary


def label_histogram(label_counts: DataFrame, label_map: DataFrame) -> DataFrame:
    """Count and share per label id, ids without a name are shown as such."""
    named = label_counts.join(vocabulary.names_of(label_map), "label_id", "left")
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))
    return named.select(
        "label_id",
        F.coalesce(
            F.col("label_name"), F.concat(F.lit("Unknown ID: "), F.col("label_id").cast("string"))
        ).alias("label_name"),
        "n",
        (F.col("n") / total * 100).alias("pct"),
    ).orderBy("label_id")


def _per_file(examples: DataFrame) -> DataFrame:
    return examples.groupBy("filename").agg(F.count("*").alias("n"))


def duplicate_files(examples: DataFrame) -> DataFrame:
    return _per_file(examples).filter(F.col("n") > 1).orderBy(F.desc("n"), "filename")


def file_stats(examples: DataFrame) -> DataFrame:
    return _per_file(examples).agg(
        F.count("*").alias("unique_files"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_files"),
        F.count_if(F.col("n") > 1).alias("duplicate_files"),
    )
