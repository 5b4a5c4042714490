"""Pair images with their label documents and turn the pairs into training examples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perennial.functions import paths, text
from perennial.sources import buckets


def pair(images: DataFrame, labels: DataFrame, how: str = "inner") -> DataFrame:
    """Join images with label documents ``(label_path, value)`` on the derived label path.

    Object paths are unique on both sides, so the join keys spread evenly.
    Images may bring their ``label_path``: tables of :func:`store_for_pairing`
    are joined without a shuffle.
    """
    stored = "label_path" in images.columns
    wanted = images if stored else images.withColumn("label_path", paths.label_path(F.col("path")))
    parsed = labels.select("label_path", text.parse_label_json(F.col("value")).alias("doc"))
    return wanted.join(parsed, "label_path", how).select(
        "label_path",
        *[c for c in images.columns if c != "label_path"],
        F.col("doc.valid").alias("valid_json"),
        "doc.model_label",
        "doc.api_label",
    )


def store_for_pairing(images: DataFrame, labels: DataFrame, buckets_: int | None = None) -> tuple[str, str]:
    """Images and label documents as tables in buckets of the label path, for repeated pairing."""
    keyed = images.withColumn("label_path", paths.label_path(F.col("path")))
    return (
        buckets.store(keyed, "images", ["label_path"], buckets_),
        buckets.store(labels.select("label_path", "value"), "label-documents", ["label_path"], buckets_),
    )


def examples(pairs: DataFrame, label_map: DataFrame) -> DataFrame:
    """Pairs whose label is in the vocabulary, with file name and label id.

    ``label_map`` should be a stored table (a file or a staged result): then its
    true size decides between a broadcast and a shuffled join.
    """
    known = label_map.select(F.col("class_name").alias("api_label"), "label_id")
    kept = [c for c in pairs.columns if c != "api_label"]
    return pairs.join(known, "api_label").select(
        *kept,
        F.col("api_label").alias("class_name"),
        "label_id",
        paths.file_stem(F.col("path")).alias("filename"),
    )


def labels_counted(pairs: DataFrame, label_map: DataFrame) -> DataFrame:
    """Examples per class. Counting comes first, so the lookup sees one row per class."""
    counts = (
        pairs.filter(F.col("api_label").isNotNull())
        .groupBy(F.col("api_label").alias("class_name"))
        .agg(F.count("*").alias("example_count"))
    )
    return counts.join(label_map.select("class_name", "label_id"), "class_name")


def dataset_size(counted: DataFrame) -> DataFrame:
    """Number of examples, 0 when there are none."""
    return counted.agg(F.coalesce(F.sum("example_count"), F.lit(0)).cast("bigint").alias("dataset_size"))


def class_distribution(counted: DataFrame, model_version: str, run_timestamp: str) -> DataFrame:
    """Statistics rows of one run; the run time is an argument, the same on every row."""
    return counted.select(
        F.lit(model_version).alias("model_version"),
        F.col("class_name").alias("class_label"),
        "label_id",
        "example_count",
        F.lit(run_timestamp).cast("timestamp").alias("run_timestamp"),
    )


def judged(images: DataFrame, labels: DataFrame, label_map: DataFrame) -> DataFrame:
    """Every image once, with its class or the reason why it gives no example.

    ``path, label_path, filename, class_name, label_id, reason``; the reason is
    null for images that are examples. One pass serves both outcomes, so a
    sampled input is drawn once. ``label_map`` should be a stored table.
    """
    known = label_map.select(F.col("class_name").alias("api_label"), "label_id", F.lit(True).alias("known"))
    paired = pair(images, labels, how="left").join(known, "api_label", "left")
    return paired.select(
        "path",
        "label_path",
        paths.file_stem(F.col("path")).alias("filename"),
        F.col("api_label").alias("class_name"),
        F.col("label_id").cast("bigint").alias("label"),
        _reason().alias("reason"),
    )


def quarantine(images: DataFrame, labels: DataFrame, label_map: DataFrame) -> DataFrame:
    """Rows that yield no example, with the reason, one row per image."""
    known = label_map.select(F.col("class_name").alias("api_label"), F.lit(True).alias("known"))
    judged = pair(images, labels, how="left").join(known, "api_label", "left")
    return judged.select("path", "label_path", "api_label", _reason().alias("reason")).filter(
        F.col("reason").isNotNull()
    )


def quarantine_counts(images: DataFrame, labels: DataFrame, label_map: DataFrame) -> DataFrame:
    """Images lost per reason; rows are counted per label before the vocabulary lookup."""
    known = label_map.select(F.col("class_name").alias("api_label"), F.lit(True).alias("known"))
    counted = (
        pair(images, labels, how="left")
        .groupBy("valid_json", "api_label")
        .agg(F.count("*").alias("n"))
        .join(known, "api_label", "left")
    )
    return (
        counted.select(_reason().alias("reason"), "n")
        .filter(F.col("reason").isNotNull())
        .groupBy("reason")
        .agg(F.sum("n").alias("n"))
    )


def _reason():
    return (
        F.when(F.col("valid_json").isNull(), F.lit("missing_label"))
        .when(~F.col("valid_json"), F.lit("bad_json"))
        .when(F.col("api_label").isNull(), F.lit("no_api_label"))
        .when(F.col("known").isNull(), F.lit("unknown_label"))
    )
