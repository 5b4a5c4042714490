"""The standing questions, asked of catalog tables or views by name.

Values are bound as literals of the plan, never spliced into text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perennial.operators import confusion, metrics, promotion


def table_schema(spark: SparkSession, table: str) -> DataFrame:
    """Name, type, mode and description of the columns; comments are the descriptions."""
    df = spark.table(table)
    notes = {f.name: f.metadata.get("comment", "") for f in df.schema.fields}
    return metrics.describe(df, descriptions=notes)


def top_classes_by_example_count(
    spark: SparkSession, table: str, model_version: str, limit: int = 10
) -> DataFrame:
    return metrics.top_classes_by_count(spark.table(table), model_version, limit)


def top_breeds_by_accuracy(
    spark: SparkSession, table: str, model_version: str, limit: int = 10
) -> DataFrame:
    return metrics.top_classes_by_accuracy(spark.table(table), model_version, limit)


def breed_accuracy(spark: SparkSession, table: str, model_version: str, breed: str) -> DataFrame:
    return metrics.class_accuracy(spark.table(table), model_version, breed)


def winner(spark: SparkSession, table: str, champion: str, challenger: str) -> DataFrame:
    """Scores of both versions and the one to serve."""
    state = spark.createDataFrame([(champion, challenger)], "champion string, challenger string")
    scores = metrics.accuracy_by_version(spark.table(table), [champion, challenger])
    return promotion.evaluate(state, scores)


def confusion_between(
    spark: SparkSession, table: str, start: str, end: str, lenient: bool = False
) -> DataFrame:
    """Rows of the packed matrices of a time range, both ends included."""
    packed = spark.table(table)
    kind = packed.schema["timestamp"].dataType
    at = F.col("timestamp").between(F.lit(start).cast(kind), F.lit(end).cast(kind))
    return confusion.unpack(packed.filter(at), ["model_version", "timestamp"], lenient)
