"""Stored tables and small documents the engine reads."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perennial import schemas
from perennial.operators import vocabulary
from perennial.sources import batches


def _missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def read_label_map(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """Label map document as rows. Missing: an error, or empty when not ``strict``."""
    try:
        docs = spark.read.text(path, wholetext=True)
    except AnalysisException as error:
        if strict or not _missing(error):
            raise
        return spark.createDataFrame([], schemas.LABEL_MAP)
    return vocabulary.from_json(docs)


def read_label_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header-less list of class names, one document."""
    return vocabulary.from_csv(spark.read.text(path, wholetext=True))


def read_examples(
    spark: SparkSession, path: str, columns: Iterable[str] | None = None
) -> DataFrame:
    """Training examples with the fixed schema, optionally a subset of its columns; none is an error."""
    try:
        examples = read_stored_examples(spark, path, columns)
    except AnalysisException as error:
        if _missing(error):
            raise FileNotFoundError(f"no training examples at {path}") from error
        raise
    if examples.isEmpty():
        raise FileNotFoundError(f"no training examples at {path}")
    return examples


def read_stored_examples(spark: SparkSession, path: str, columns: Iterable[str] | None = None) -> DataFrame:
    """The same where a set may be empty."""
    examples = spark.read.schema(schemas.TRAINING_EXAMPLE).parquet(path)
    return examples.select(*columns) if columns else examples


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """Images that gave no example, with the reason; a filter on the reason reads its folder only."""
    return spark.read.schema(schemas.QUARANTINE).parquet(path)


def read_dataset_size(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.DATASET_SIZE).json(path)


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """The newest promotion state: saved states never overwrite each other."""
    reader = spark.read.schema(schemas.PROMOTION_STATE).option("multiLine", True)
    states = reader.option("recursiveFileLookup", True).json(path)
    return (
        states.select("champion", "challenger", F.col("_metadata.file_path").alias("file"))
        .orderBy(F.desc("file"))
        .limit(1)
        .drop("file")
    )


def _metrics_batches(spark: SparkSession, path: str) -> DataFrame:
    stored = spark.read.schema(T.StructType([*schemas.PREDICTION_METRICS.fields, T.StructField("batch", T.StringType())])).parquet(path)
    return stored.where(batches.live(spark, path))


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the prediction log; a filter on the version reads its folders only."""
    return _metrics_batches(spark, path).select(schemas.PREDICTION_METRICS.fieldNames())


def compact_metrics(spark: SparkSession, path: str) -> int:
    """Merge the log's finished batches into one for each version; returns how many were merged."""
    return batches.compact(spark, path, lambda: _metrics_batches(spark, path), ("model_version",))


def read_distribution(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.CLASS_DISTRIBUTION).parquet(path).select(schemas.CLASS_DISTRIBUTION.fieldNames())
