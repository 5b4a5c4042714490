"""Questions asked of the prediction log and the class statistics.

Accuracy has three null rules, kept apart on purpose: :func:`accuracy_by_version`
ignores a missing verdict, the other two count it as wrong.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perennial import schemas
from perennial.functions import text
from perennial.operators.quantiles import exact_percentiles


def _correct() -> Column:
    return F.when(F.col("is_correct"), F.lit(1)).otherwise(F.lit(0))


def accuracy_by_version(log: DataFrame, versions: Sequence[str] | None = None) -> DataFrame:
    if versions is not None:
        log = log.filter(F.col("model_version").isin(*versions))
    return log.groupBy("model_version").agg(
        F.avg(F.col("is_correct").cast("int")).alias("avg_prediction_accuracy")
    )


def class_accuracy(log: DataFrame, version: str, label: str) -> DataFrame:
    """Accuracy of one class in percent; 0 when the class was never seen."""
    rows = log.filter((F.col("model_version") == version) & (F.col("actual") == label))
    return rows.agg(text.percent(F.avg(_correct().cast("double"))).alias("accuracy"))


def top_classes_by_accuracy(log: DataFrame, version: str, limit: int = 10) -> DataFrame:
    per_class = (
        log.filter(F.col("model_version") == version)
        .groupBy(F.col("actual").alias("breed"))
        .agg(F.count("*").alias("total"), F.sum(_correct()).alias("correct"))
        .withColumn("accuracy", F.try_divide(F.col("correct"), F.col("total")))
    )
    return per_class.orderBy(F.desc("accuracy"), "breed").limit(limit)


def latest_distribution(stats: DataFrame) -> DataFrame:
    """Newest statistics row of every version and class.

    Newest per class, not newest run: a class missing from the last run keeps
    its older row. The rank limit is applied before the shuffle too, so a class
    with very many runs sends one row per task.
    """
    newest = Window.partitionBy("model_version", "class_label").orderBy(
        F.desc("run_timestamp"), F.desc("example_count")
    )
    return (
        stats.withColumn("row_num", F.row_number().over(newest))
        .filter(F.col("row_num") == 1)
        .drop("row_num")
    )


def latest_run_only(stats: DataFrame) -> DataFrame:
    """The rows of each version's newest run; classes that run did not see are left out."""
    newest = stats.groupBy(F.col("model_version").alias("version_")).agg(
        F.max("run_timestamp").alias("newest_")
    )
    same = stats["model_version"].eqNullSafe(newest["version_"]) & (stats["run_timestamp"] == newest["newest_"])
    return stats.join(newest, same).drop("version_", "newest_")


def top_classes_by_count(stats: DataFrame, version: str, limit: int = 10) -> DataFrame:
    return (
        latest_distribution(stats)
        .filter(F.col("model_version") == version)
        .select("model_version", "class_label", "example_count")
        .orderBy(F.desc("example_count"), "class_label")
        .limit(limit)
    )


def hourly(log: DataFrame, at: str = "ts") -> DataFrame:
    """Volume, accuracy and latency per hour and version."""
    rows = log.withColumn("hour", F.date_trunc("hour", F.col(at)).cast("timestamp_ntz"))
    keys = ["hour", "model_version"]
    figures = [
        F.count("*").alias("n"),
        F.avg(F.col("is_correct").cast("int")).alias("accuracy"),
        F.avg("latency").alias("avg_latency"),
    ]
    points = {"p50_latency": 0.5, "p95_latency": 0.95}
    return exact_percentiles(rows, keys, "latency", points, figures)


def volume_gate(images: DataFrame, threshold: int) -> DataFrame:
    """Per version: is there enough new data to retrain?"""
    return (
        images.groupBy("version")
        .agg(F.count("*").alias("n"))
        .withColumn("retrain", F.col("n") >= threshold)
    )


def drift(stats: DataFrame, version: str, other: str) -> DataFrame:
    """KL divergence of two versions' newest class distributions.

    Natural logarithm, one added to every count over the union of classes.
    """
    counts = (
        latest_distribution(stats.filter(F.col("model_version").isin(version, other)))
        .groupBy("class_label")
        .agg(
            *[
                F.coalesce(
                    F.sum(F.when(F.col("model_version") == v, F.col("example_count"))), F.lit(0)
                ).alias(side)
                for side, v in (("a", version), ("b", other))
            ]
        )
    )
    # A single pass over the class-sized table: with P = sum(a+1) and Q = sum(b+1),
    # sum(p ln(p/q)) = sum((a+1) ln((a+1)/(b+1))) / P + ln(Q/P).
    p, q = F.col("a") + 1, F.col("b") + 1
    return counts.agg(
        (F.sum(p * F.ln(p / q)) / F.sum(p) + F.ln(F.sum(q) / F.sum(p))).alias("kl")
    )


def describe(
    df: DataFrame,
    declared: T.StructType | None = None,
    descriptions: dict[str, str] | None = None,
) -> DataFrame:
    """Name, type, mode and description of every column of a table, from its metadata.

    No row is read. Parquet reads every column as nullable, so modes and
    descriptions come from the schema the table was declared with, where there
    is one, else from the table's own; ``descriptions`` come before both.
    """
    known = {f.name: f for f in (declared or df.schema).fields}
    rows = []
    for field in df.schema.fields:
        told = known.get(field.name, field)
        note = (descriptions or {}).get(field.name) or told.metadata.get("comment", "")
        mode = "NULLABLE" if told.nullable else "REQUIRED"
        rows.append((field.name, schemas.warehouse_type(field.dataType), mode, note))
    return df.sparkSession.createDataFrame(
        rows, "name string, type string, mode string, description string"
    )
