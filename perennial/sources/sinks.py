"""Where results are written."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perennial import schemas
from perennial.functions import paths, text
from perennial.operators import vocabulary


def write_examples(examples: DataFrame, root: str, version: str) -> str:
    path = f"{root}/processed/{version}/data"
    examples.write.mode("overwrite").parquet(path)
    return path


def write_dataset_size(size: DataFrame, root: str, version: str) -> str:
    """One JSON line ``{"dataset_size": n}``; the input is one row."""
    path = f"{root}/processed/{version}/metadata"
    size.select(F.to_json(F.struct("dataset_size"))).coalesce(1).write.mode("overwrite").text(path)
    return path


# Folder of rows without a reason in a tagged table: the examples.
_NO_REASON = "none"


def write_tagged(rows: DataFrame, staged: str, mode: str = "append") -> None:
    """Rows with their ``reason`` (null for examples) in one pass, a folder for each outcome."""
    tagged = rows.withColumn("reason", F.coalesce("reason", F.lit(_NO_REASON)))
    tagged.write.mode(mode).partitionBy("reason").parquet(staged)


def publish_tagged(spark: SparkSession, staged: str, root: str, version: str) -> tuple[str, str]:
    """Put a finished tagged table in place: its examples, and the rest as the quarantine by reason.

    Folders are renamed, nothing is written again; what stood there before goes.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    base = f"{root}/processed/{version}"
    store = hadoop.Path(staged).getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(hadoop.Path(f"{staged}/reason={_NO_REASON}"))
    store.mkdirs(hadoop.Path(base))
    for source, target in ((f"{staged}/reason={_NO_REASON}", f"{base}/data"), (staged, f"{base}/quarantine")):
        store.delete(hadoop.Path(target), True)
        if not store.rename(hadoop.Path(source), hadoop.Path(target)):
            raise OSError(f"{source} could not be renamed to {target}")
    return f"{base}/data", f"{base}/quarantine"


def write_quarantine(rows: DataFrame, path: str) -> None:
    """Put rows with a ``reason`` into a quarantine; rows of the same reasons are replaced, so a rerun adds nothing."""
    stored = schemas.conform(rows, schemas.QUARANTINE)
    (
        stored.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("reason")
        .parquet(path)
    )


def append_distribution(rows: DataFrame, path: str, run: str | None = None) -> None:
    """Append class statistics; a null in any column stops the write.

    They lie in folders by version and run: a run written again under its name
    replaces its own rows of each version it has, so a retry doubles nothing.
    Without a name rows are added as they are.
    """
    checked = schemas.conform(rows, schemas.CLASS_DISTRIBUTION)
    name = re.sub(r"\W+", "_", run) if run else uuid.uuid4().hex
    (
        checked.withColumn("batch", F.lit(name))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("model_version", "batch")
        .parquet(path)
    )


def append_predictions(rows: DataFrame, path: str, batch: str | None = None) -> None:
    """Add rows to the prediction log, which jobs and streams write alike.

    The log lies in folders by version and batch, so a question about one
    version reads that version's folders. A batch written again under its name
    replaces its own rows; without a name it gets a new one.
    """
    checked = schemas.conform(rows, schemas.PREDICTION_METRICS)
    (
        checked.withColumn("batch", F.lit(batch or uuid.uuid4().hex))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("model_version", "batch")
        .parquet(path)
    )


def write_prediction_batch(rows: DataFrame, path: str, stream: str, batch_id: int) -> None:
    """A stream's batch, under a name that a retry bears again."""
    append_predictions(rows, path, f"{stream}-{batch_id}")


def append_training_metrics(rows: DataFrame, path: str) -> None:
    schemas.conform(rows, schemas.TRAINING_METRICS).write.mode("append").parquet(path)


def write_routed(rows: DataFrame, path: str, mode: str = "append") -> None:
    """Images and label documents by version and outcome.

    ``rows`` come from ``scoring.routed`` and may carry the image ``content``.
    Rebalancing splits a version that holds most rows over several files and
    packs small ones together.
    """
    stored = rows.select(
        "model_version",
        "outcome",
        F.concat("path", F.lit(paths.IMAGE_SUFFIX)).alias("image_path"),
        F.concat("path", F.lit(paths.LABEL_SUFFIX)).alias("label_path"),
        text.label_json(F.col("predicted"), F.col("actual")).alias("label_json"),
        *[c for c in ("content",) if c in rows.columns],
    )
    (
        stored.hint("rebalance", "model_version", "outcome")
        .write.mode(mode)
        .partitionBy("model_version", "outcome")
        .parquet(path)
    )


def save_label_map(label_map: DataFrame, path: str) -> None:
    """Save to a fresh path: the input may still be read from the old one."""
    vocabulary.to_json(label_map).coalesce(1).write.mode("errorifexists").text(path)


def save_state(state: DataFrame, path: str, saved_at: str) -> str:
    """Add a state below ``path``; names sort by time, so the newest is the last."""
    target = f"{path}/state-{saved_at}"
    state.select(
        F.to_json(F.struct("champion", "challenger"), {"ignoreNullFields": "false"})
    ).coalesce(1).write.mode("errorifexists").text(target)
    return target


def save_listing(listing: DataFrame, path: str) -> None:
    """One path per line."""
    listing.select("path").write.mode("errorifexists").text(path)


def one_row(spark: SparkSession, values: dict[str, object], schema) -> DataFrame:
    """An in-memory row with a fixed schema, e.g. one metrics record."""
    return spark.createDataFrame([tuple(values[f.name] for f in schema.fields)], schema)
