"""Whole jobs: chains of the operators, from stored objects to stored tables."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from perennial.functions import matching, paths, versions
from perennial.operators import (
    curation,
    images,
    metrics,
    promotion,
    replay,
    scoring,
    training,
    validation,
    vocabulary,
)
from perennial.operators.ranking import DEFAULT_SEED
from perennial.session import delete_on_exit, many_files, released, stage
from perennial.sources import objects, sinks, tables


def build_training_set(
    inventory: DataFrame,
    labels: DataFrame,
    label_map: DataFrame,
    version: str,
    seed: int = DEFAULT_SEED,
    outcomes: Iterable[str] = (paths.INCORRECT,),
) -> DataFrame:
    """Current and replayed images with their class: ``path, origin, filename, class_name, label_id``.

    Label documents of other versions and outcomes are dropped before the join,
    which cannot tell from an image path that they will never match.
    """
    outcomes = tuple(outcomes)
    chosen = replay.training_paths(inventory, version, seed=seed, outcomes=outcomes)
    candidates = _candidates(labels, version, outcomes)
    return curation.examples(curation.pair(chosen, candidates), label_map).select(
        "path", "origin", "filename", "class_name", "label_id"
    )


# Images whose paths the driver holds at once.
BLOCK_PATHS = 50_000


@dataclass
class Preprocessed:
    examples: str
    metadata: str
    quarantine: str


def preprocess(
    spark: SparkSession,
    root: str,
    version: str,
    run_timestamp: str,
    distribution_path: str,
    seed: int = DEFAULT_SEED,
    outcomes: Iterable[str] = (paths.INCORRECT,),
    block: int = BLOCK_PATHS,
) -> Preprocessed:
    """List, sample, pair, decode and store one version's training set.

    The inventory is sampled once: every chosen image gets its class or the
    reason why it has none, in one narrow table. Only images with a class are
    opened, ``block`` of them at a time, so the driver holds the paths of one
    block. All rows go to one table by outcome, a broken image as
    ``bad_image``; its folders become the examples and the quarantine when all
    blocks are there. Number and statistics are read from the stored examples,
    one label column, instead of keeping decoded images in memory.
    """
    outcomes = tuple(outcomes)
    major, _ = versions.job_version(version)
    if not re.search(versions.VERSION_ID, version):
        raise ValueError(f"version {version!r} has characters that no version id has")
    family = f"{major}_*"
    label_map = tables.read_label_map(spark, f"{root}/processed/metadata/label_map.json")
    inventory = objects.list_objects(spark, root, family, outcomes, "*" + paths.IMAGE_SUFFIX)
    labels = objects.read_label_files(spark, root, family, outcomes)
    chosen = replay.training_paths(stage(inventory, "inventory"), version, seed=seed, outcomes=outcomes)
    judged = stage(curation.judged(chosen, _candidates(labels, version, outcomes), label_map), "judged-images")
    no_pixels = {n: F.lit(None).cast(kind) for n, kind in (("height", "int"), ("width", "int"), ("n_channels", "int"), ("image", "binary"))}
    staged = f"{root}/processed/{version}/_staged-{uuid.uuid4().hex}"
    delete_on_exit(spark, staged)
    sinks.write_tagged(judged.where("reason is not null").withColumns(no_pixels), staged)
    settled = judged.where("reason is null").drop("reason")
    blocks = -(-settled.count() // block)
    for number in range(blocks):
        part = settled.where(F.pmod(F.xxhash64("path"), F.lit(blocks)) == number)
        with many_files(spark):
            sinks.write_tagged(_with_pixels(spark, root, part), staged)
    data, quarantined = sinks.publish_tagged(spark, staged, root, version)
    counted = (
        tables.read_stored_examples(spark, data, ["class_name", "label"])
        .groupBy("class_name", F.col("label").alias("label_id"))
        .agg(F.count("*").alias("example_count"))
    )
    metadata = sinks.write_dataset_size(curation.dataset_size(counted), root, version)
    sinks.append_distribution(
        curation.class_distribution(counted, version, run_timestamp), distribution_path, run_timestamp
    )
    return Preprocessed(data, metadata, quarantined)


def _candidates(labels: DataFrame, version: str, outcomes: tuple[str, ...]) -> DataFrame:
    """Label documents that images of the version or its replay can have."""
    owner = paths.version_of(F.col("label_path"))
    return labels.filter(
        ((owner == version) | versions.is_earlier(owner, version))
        & paths.outcome_of(F.col("label_path")).isin(*outcomes)
    )


def _with_pixels(spark: SparkSession, root: str, part: DataFrame) -> DataFrame:
    """Settled images with their pixels; one without gets the reason ``bad_image``."""
    wanted = [r["path"] for r in part.select("path").collect()]
    decoded = images.to_rgb(objects.read_images_at(spark, root, wanted))
    return part.join(decoded, "path", "left").withColumn(
        "reason", F.when(F.col("image").isNull(), F.lit("bad_image"))
    )


def training_input(
    spark: SparkSession,
    examples_path: str,
    label_map_path: str,
    validation_share: float = 0.3,
    batch: int = 32,
    seed: int = DEFAULT_SEED,
    shape: tuple[int, int, int] | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Batched training rows, validation rows and class weights of a stored set.

    Rows carry the key only; pixels are joined where they are consumed. With a
    ``shape``, images of other shapes go to the quarantine beside the examples,
    as ``bad_shape``. A run with another shape replaces them.
    """
    examples = tables.read_examples(spark, examples_path)
    if shape:
        examples, misshapen = images.split_by_shape(examples, shape)
        sinks.write_quarantine(
            misshapen.withColumn("label_path", F.lit(None)), f"{examples_path.rstrip('/').rsplit('/', 1)[0]}/quarantine"
        )
    examples = examples.select("path", "label")
    label_map = training.require_vocabulary(tables.read_label_map(spark, label_map_path))
    parted = training.split(examples, "path", validation_share, seed)
    train = parted.filter(F.col("part") == "train").drop("part")
    counts = train.groupBy(F.col("label").alias("label_id")).agg(F.count("*").alias("n"))
    return (
        training.batched(training.shuffled(train, "path", seed), batch),
        parted.filter(F.col("part") == "val").drop("part"),
        training.class_weights(counts, label_map),
    )


def refresh_vocabulary(
    spark: SparkSession, listing: DataFrame, path: str, target: str
) -> DataFrame | None:
    """Add labels seen in label file names; None when there is nothing new."""
    label_map = tables.read_label_map(spark, path, strict=False)
    fresh = stage(
        vocabulary.new_labels(listing.filter(paths.is_label_file(F.col("path"))), label_map),
        "new-labels",
    )
    if fresh.isEmpty():
        return None
    sinks.save_label_map(vocabulary.extend(label_map, fresh), target)
    return tables.read_label_map(spark, target)


def judge(scored: DataFrame, label_map: DataFrame) -> DataFrame:
    """Decode the best class of every row and compare it with the true label."""
    named = scoring.decode(scoring.predict(scored).drop("scores"), label_map)
    return matching.with_matches(named).withColumn(
        "is_correct", matching.is_match(F.col("model_version"))
    )


def score_and_log(
    scored: DataFrame, label_map: DataFrame, log_path: str, routed_path: str | None = None
) -> None:
    """Judge scored rows, keep their images and append the log.

    ``scored`` has ``event_id, ts, model_version, actual, latency, scores`` and may
    carry the image ``content``.
    """
    judged = judge(scored, label_map)
    if routed_path:
        sinks.write_routed(scoring.routed(judged), routed_path)
    sinks.append_predictions(judged.withColumnRenamed("ts", "timestamp"), log_path)


def score_stream(
    scored: DataFrame,
    label_map: DataFrame,
    log_path: str,
    checkpoint: str,
    routed_path: str | None = None,
    compact_every: int = 100,
) -> StreamingQuery:
    """The same on a stream: rows are stored under their batch, so a retried batch rewrites its own.

    The stream is named by its checkpoint folder. Its images are routed too if
    ``routed_path`` is given. What a batch stages goes with it; every
    ``compact_every`` batches the log's finished batches are merged.
    """
    name = checkpoint.rstrip("/").rsplit("/", 1)[-1]

    def log(batch: DataFrame, batch_id: int) -> None:
        with released(batch.sparkSession):
            rows = judge(batch, label_map)
            if routed_path:
                sinks.write_routed(scoring.routed(rows), f"{routed_path}/batch={name}-{batch_id}", "overwrite")
            sinks.write_prediction_batch(rows.withColumnRenamed("ts", "timestamp"), log_path, name, batch_id)
            if compact_every and batch_id % compact_every == compact_every - 1:
                tables.compact_metrics(batch.sparkSession, log_path)

    return (
        scored.writeStream.foreachBatch(log)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def promote(
    spark: SparkSession, log: DataFrame, state_path: str, saved_at: str, deployed_at: str
) -> DataFrame:
    """Judge champion and challenger on the log and save the next state."""
    current = tables.read_state(spark, state_path)
    pair = current.select(
        F.col("champion.model_version").alias("champion"),
        F.col("challenger.model_version").alias("challenger"),
    )
    # two names: the log is read for these versions only
    rivals = [name for row in pair.take(1) for name in row if name is not None]
    accuracy = metrics.accuracy_by_version(log, rivals)
    decision = stage(promotion.step(promotion.evaluate(pair, accuracy)), "promotion")
    sinks.save_state(promotion.next_state(decision, current, deployed_at), state_path, saved_at)
    return decision


def validation_report(
    spark: SparkSession, examples_path: str, label_map_path: str
) -> dict[str, DataFrame]:
    """Label histogram, file counts and repeated files of a stored set."""
    examples = tables.read_examples(spark, examples_path, ["filename", "label"])
    counts = examples.groupBy(F.col("label").alias("label_id")).agg(F.count("*").alias("n"))
    return {
        "labels": validation.label_histogram(counts, tables.read_label_map(spark, label_map_path)),
        "files": validation.file_stats(examples),
        "duplicates": validation.duplicate_files(examples),
    }


def deployed_at(now) -> str:
    """ISO time with a closing ``Z``, as the promotion state holds it."""
    return now.isoformat() + "Z"

