"""Every operator as a named query over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perennial import schemas
from perennial.functions import matching, paths, text, vectors, versions
from perennial.operators import (
    confusion,
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
from perennial.plans import jobs, views
from perennial.session import delete_on_exit, fresh_path, stage
from perennial.sources import object_store, objects, sinks, tables
from perennial.streaming import metrics as streams

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries; the oracle texts name the same ones.
CURRENT = "v3_10"
NEXT = "v3_11"
VERSION = "v3_3"
CHAMPION = "v3_9"
VALIDATION = 0.3
BATCH = 32
RUN_AT = "2024-02-01 00:00:00"
GATE = 46

_queries: dict[str, Query] = {}


def query(function: Query) -> Query:
    _queries[function.__name__] = function
    return function


def queries() -> dict[str, Query]:
    return dict(_queries)


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


# --- objects and labels ---------------------------------------------------------------


@query
def list_current_version(spark, sf_dir):
    return replay.current_images(views.image_objects(spark, sf_dir), CURRENT)


@query
def list_by_prefix(spark, sf_dir):
    prefixes = ["v3_0/correct_predictions/", "v3_0/incorrect_predictions/"]
    listed = replay.list_by_prefix(views.image_objects(spark, sf_dir), prefixes)
    return listed.groupBy("prefix").agg(F.count("*").alias("n"))


@query
def list_label_files(spark, sf_dir):
    path = F.col("label_path")
    return (
        views.label_objects(spark, sf_dir)
        .filter(
            paths.is_label_file(path)
            & paths.outcome_of(path).isin(paths.CORRECT, paths.INCORRECT)
        )
        .select("label_path")
    )


@query
def list_json_capped(spark, sf_dir):
    shouted = F.when(F.col("doc_id") % 2 == 0, F.upper("label_path")).otherwise(F.col("label_path"))
    return objects.list_json(views.label_objects(spark, sf_dir).select(shouted.alias("path")), 50)


@query
def earlier_versions(spark, sf_dir):
    return replay.earlier_versions(views.image_objects(spark, sf_dir), CURRENT)


def _pairs(spark, sf_dir) -> DataFrame:
    """Wrongly predicted images with their labels; other labels are dropped before the join."""
    wrong = replay.images_of(views.image_objects(spark, sf_dir))
    labels = views.label_objects(spark, sf_dir)
    return curation.pair(
        wrong, labels.filter(paths.outcome_of(F.col("label_path")) == paths.INCORRECT)
    )


@query
def pair_image_label(spark, sf_dir):
    return _pairs(spark, sf_dir).select("path", "label_path", "api_label")


@query
def pair_stored(spark, sf_dir):
    """The same from tables in buckets of the label path: the join moves nothing."""
    images_, labels = curation.store_for_pairing(
        replay.images_of(views.image_objects(spark, sf_dir)), views.label_objects(spark, sf_dir)
    )
    return curation.pair(spark.table(images_), spark.table(labels)).select("path", "label_path", "api_label")


@query
def label_json_parse(spark, sf_dir):
    docs = views.label_objects(spark, sf_dir)
    parsed = docs.select("label_path", text.parse_label_json(F.col("value")).alias("doc"))
    return parsed.select("label_path", "doc.model_label", "doc.api_label")


@query
def quarantine_reasons(spark, sf_dir):
    return curation.quarantine_counts(
        replay.images_of(views.image_objects(spark, sf_dir)),
        views.label_objects(spark, sf_dir),
        views.stored_earlier_label_map(spark, sf_dir),
    )


@query
def label_map_explode(spark, sf_dir):
    return vocabulary.from_json(views.label_map_document(spark, sf_dir))


@query
def label_map_from_csv(spark, sf_dir):
    """The class names as a name list file: one document, a name per line, blanks at the end."""
    names = views.label_map(spark, sf_dir).agg(
        F.array_sort(F.collect_list(F.struct("label_id", "class_name"))).alias("names")
    )
    lines = F.transform("names", lambda e: F.concat(e["class_name"], F.lit(" ")))
    return vocabulary.from_csv(names.select(F.array_join(lines, "\n").alias("value")))


@query
def new_labels(spark, sf_dir):
    return vocabulary.new_labels(
        views.image_objects(spark, sf_dir), views.stored_earlier_label_map(spark, sf_dir)
    )


@query
def label_map_update(spark, sf_dir):
    known = views.stored_earlier_label_map(spark, sf_dir)
    return vocabulary.extend(
        known, vocabulary.new_labels(views.image_objects(spark, sf_dir), known)
    )


# --- training set ---------------------------------------------------------------------


def _examples(spark, sf_dir) -> DataFrame:
    return curation.examples(_pairs(spark, sf_dir), views.stored_earlier_label_map(spark, sf_dir)).select(
        "path", "filename", "class_name", "label_id"
    )


def _stored_examples(spark, sf_dir) -> DataFrame:
    """Ranking reads its input more than once, so the join behind it is stored first."""
    return stage(_examples(spark, sf_dir), "examples")


def _counted(spark, sf_dir) -> DataFrame:
    return curation.labels_counted(_pairs(spark, sf_dir), views.stored_earlier_label_map(spark, sf_dir))


@query
def training_examples(spark, sf_dir):
    return _examples(spark, sf_dir).select("filename", "class_name", "label_id")


@query
def read_examples(spark, sf_dir):
    """Through the writer and the reader of training sets; a path's bytes stand for its pixels."""
    pixels = F.col("path").cast("binary")
    rows = _examples(spark, sf_dir).select(
        "path",
        "filename",
        "class_name",
        F.col("label_id").cast("bigint").alias("label"),
        pixels.alias("image"),
        F.lit(1).alias("height"),
        F.length(pixels).alias("width"),
        F.lit(1).alias("n_channels"),
    )
    stored = sinks.write_examples(rows, fresh_path(spark, "examples"), CURRENT)
    return tables.read_examples(spark, stored, ["filename", "label"]).select(
        "filename", F.col("label").cast("int").alias("label_id")
    )


@query
def dataset_size(spark, sf_dir):
    return curation.dataset_size(_counted(spark, sf_dir))


@query
def class_distribution(spark, sf_dir):
    return curation.class_distribution(_counted(spark, sf_dir), CURRENT, RUN_AT).drop("run_timestamp")


@query
def replay_sample(spark, sf_dir):
    return replay.replay_sample(views.image_objects(spark, sf_dir), CURRENT).select("version", "path")


@query
def replay_sample_pooled(spark, sf_dir):
    return replay.pooled_replay_sample(views.image_objects(spark, sf_dir), "v3", CURRENT).select("path")


@query
def replay_sample_pooled_next(spark, sf_dir):
    """The variant that leaves out the version about to be trained."""
    return replay.pooled_replay_sample(views.image_objects(spark, sf_dir), "v3", NEXT).select("path")


@query
def training_paths(spark, sf_dir):
    return replay.training_paths(views.image_objects(spark, sf_dir), CURRENT).select("path", "origin")


@query
def training_set(spark, sf_dir):
    return jobs.build_training_set(
        views.image_objects(spark, sf_dir),
        views.label_objects(spark, sf_dir),
        views.stored_earlier_label_map(spark, sf_dir),
        CURRENT,
    )


@query
def train_val_split(spark, sf_dir):
    return training.split(_stored_examples(spark, sf_dir), "path", VALIDATION).select("filename", "part")


@query
def split_sizes(spark, sf_dir):
    return training.split_sizes(curation.dataset_size(_counted(spark, sf_dir)), VALIDATION, BATCH)


@query
def shuffled_examples(spark, sf_dir):
    return training.shuffled(_stored_examples(spark, sf_dir), "path").select("filename", "position")


@query
def batch_counts(spark, sf_dir):
    batches = training.batched(training.shuffled(_stored_examples(spark, sf_dir), "path"), BATCH)
    return batches.groupBy("batch_id").agg(F.count("*").alias("n"))


def _label_counts(spark, sf_dir, label_map: DataFrame) -> DataFrame:
    counted = curation.labels_counted(_pairs(spark, sf_dir), label_map)
    return counted.groupBy("label_id").agg(F.sum("example_count").alias("n"))


@query
def class_weights(spark, sf_dir):
    label_map = views.stored_earlier_label_map(spark, sf_dir)
    # The counts feed both the total and the lookup.
    counts = stage(_label_counts(spark, sf_dir, label_map), "label-counts")
    return _rounded(training.class_weights(counts, label_map), "weight")


@query
def label_histogram(spark, sf_dir):
    """Counts by the whole vocabulary, named by one without the French classes: their ids are unknown."""
    label_map = views.stored_label_map(spark, sf_dir)
    known = label_map.filter(~F.endswith("class_name", F.lit(" fr")))
    return _rounded(
        validation.label_histogram(_label_counts(spark, sf_dir, label_map), known), "pct"
    )


def _named_files(spark, sf_dir) -> DataFrame:
    return views.image_objects(spark, sf_dir).select(
        F.concat_ws("_", "class_name", (F.col("doc_id") % 20).cast("string")).alias("filename")
    )


@query
def duplicate_files(spark, sf_dir):
    return validation.duplicate_files(_named_files(spark, sf_dir))


@query
def file_stats(spark, sf_dir):
    return validation.file_stats(_named_files(spark, sf_dir))


# --- metrics --------------------------------------------------------------------------


def _evaluated(spark, sf_dir) -> DataFrame:
    log = views.prediction_metrics(spark, sf_dir)
    state = spark.createDataFrame([(CHAMPION, CURRENT)], "champion string, challenger string")
    return promotion.evaluate(state, metrics.accuracy_by_version(log, [CHAMPION, CURRENT]))


@query
def champion_scores(spark, sf_dir):
    log = views.prediction_metrics(spark, sf_dir)
    return _rounded(metrics.accuracy_by_version(log, [CHAMPION, CURRENT]), "avg_prediction_accuracy")


@query
def champion_winner(spark, sf_dir):
    return _rounded(_evaluated(spark, sf_dir), "champion_score", "challenger_score")


@query
def promotion_step(spark, sf_dir):
    return promotion.step(_evaluated(spark, sf_dir))


@query
def breed_accuracy(spark, sf_dir):
    return metrics.class_accuracy(views.prediction_metrics(spark, sf_dir), VERSION, "click")


@query
def top_breeds(spark, sf_dir):
    return _rounded(
        metrics.top_classes_by_accuracy(views.prediction_metrics(spark, sf_dir), VERSION), "accuracy"
    )


@query
def latest_distribution(spark, sf_dir):
    return metrics.latest_distribution(views.class_distribution(spark, sf_dir)).select(
        "model_version", "class_label", "example_count", "run_timestamp"
    )


@query
def latest_run_only(spark, sf_dir):
    return metrics.latest_run_only(views.class_distribution(spark, sf_dir)).select(
        "model_version", "class_label", "example_count", "run_timestamp"
    )


@query
def top_classes(spark, sf_dir):
    return metrics.top_classes_by_count(views.class_distribution(spark, sf_dir), VERSION, 3)


@query
def confusion_matrix(spark, sf_dir):
    return confusion.build(views.prediction_metrics(spark, sf_dir), ["model_version"])


@query
def confusion_pack(spark, sf_dir):
    return views.model_metrics(spark, sf_dir)


@query
def confusion_chunks(spark, sf_dir):
    """Matrices by version and day in chunks of three entries, about."""
    log = views.prediction_metrics(spark, sf_dir).withColumn("ts", F.date_trunc("day", F.col("ts")).cast("timestamp_ntz"))
    by = ["model_version", "ts"]
    return confusion.pack_chunks(confusion.build(log, by), by, 3)


@query
def confusion_unpack(spark, sf_dir):
    low = F.lit("2024-01-05").cast("timestamp_ntz")
    high = F.lit("2024-01-20").cast("timestamp_ntz")
    packed = views.model_metrics(spark, sf_dir).filter(F.col("ts").between(low, high))
    return confusion.unpack(packed, ["model_version", "ts"])


@query
def metrics_hourly(spark, sf_dir):
    return _rounded(
        metrics.hourly(views.prediction_metrics(spark, sf_dir)),
        "accuracy",
        "avg_latency",
        "p50_latency",
        "p95_latency",
    )


@query
def retrain_gate(spark, sf_dir):
    return metrics.volume_gate(replay.images_of(views.image_objects(spark, sf_dir)), GATE)


@query
def kl_divergence(spark, sf_dir):
    return _rounded(metrics.drift(views.class_distribution(spark, sf_dir), VERSION, CURRENT), "kl")


@query
def routed_predictions(spark, sf_dir):
    log = views.prediction_metrics(spark, sf_dir).withColumn("ts", paths.as_utc(F.col("ts")))
    return scoring.routed(log).select("event_id", "path")


@query
def describe_table(spark, sf_dir):
    """The class statistics as they are stored: their types, modes and descriptions as declared."""
    rows = views.class_distribution(spark, sf_dir).withColumn(
        "run_timestamp", paths.as_utc(F.col("run_timestamp"))
    )
    return metrics.describe(schemas.conform(rows, schemas.CLASS_DISTRIBUTION), schemas.CLASS_DISTRIBUTION)


# --- functions ------------------------------------------------------------------------


def _versions(spark, sf_dir, *more: str | None) -> DataFrame:
    seen = views.image_objects(spark, sf_dir).select("version").distinct()
    return seen.unionByName(
        spark.createDataFrame([(v,) for v in more], "version string")
    ).distinct()


@query
def valid_version_ids(spark, sf_dir):
    known = _versions(spark, sf_dir, "v 3", "v3/1", "")
    return known.withColumn("ok", versions.is_valid_id(F.col("version")))


@query
def parse_versions(spark, sf_dir):
    version = F.col("version")
    return _versions(spark, sf_dir, "v3_0", "bad", None).select(
        "version", versions.major(version).alias("major"), versions.minor(version).alias("minor")
    )


@query
def next_version(spark, sf_dir):
    known = _versions(spark, sf_dir, "v3_0", "bad", None)
    return known.withColumn("next", versions.next_version(F.col("version")))


@query
def training_mode(spark, sf_dir):
    known = _versions(spark, sf_dir, "v3_0", "bad", None)
    return known.withColumn("mode", versions.training_mode(F.col("version")))


@query
def strict_versions(spark, sf_dir):
    """The strict split of a job's version; other spellings have none."""
    known = _versions(spark, sf_dir, "v3_0", "bad", "v3_1_2", "v3_x", None)
    return known.select(
        "version", *[versions.strict(F.col("version"))[part].alias(part) for part in ("prefix", "number")]
    )


@query
def whole_numbers(spark, sf_dir):
    stated = views.table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("value")).distinct()
    keys = views.table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("string").alias("value"))
    return stated.union(keys).withColumn("ok", versions.is_whole_number(F.col("value")))


@query
def deployed_texts(spark, sf_dir):
    """Times as the promotion state holds them, whole seconds and others."""
    at = F.timestamp_micros(F.unix_micros(paths.as_utc(F.col("ts"))) + F.col("event_id") % 3 * 250)
    return views.table(spark, sf_dir, "events").select("event_id", text.deployed_text(at).alias("deployed_at"))


@query
def time_texts(spark, sf_dir):
    at = paths.as_utc(F.col("ts"))
    return views.table(spark, sf_dir, "events").select(
        "event_id", text.hour_folder(at).alias("hour_folder"), text.rfc3339(at).alias("rfc3339")
    )


@query
def run_name(spark, sf_dir):
    version = F.concat(F.lit("v3_"), (F.col("user_id") % 12).cast("string"))
    return views.table(spark, sf_dir, "events").select(
        "event_id",
        text.run_name("training", F.col("ts")).alias("run_name"),
        text.experiment_name(version).alias("experiment_name"),
    )


@query
def url_breed(spark, sf_dir):
    return views.table(spark, sf_dir, "pages").select(
        "page_id", paths.label_in_url(F.col("url")).alias("breed")
    )


@query
def normalize_label(spark, sf_dir):
    pairs = views.label_pairs(spark, sf_dir)
    seen = pairs.select(F.explode(F.array("actual", "predicted")).alias("label"))
    spelled = [*matching.ALIASES, "  Hound-Afghan_hound "]
    extra = spark.createDataFrame([(s,) for s in spelled], "label string")
    labels = seen.distinct().unionByName(extra).distinct()
    return labels.select(
        "label", F.array_join(matching.words(F.col("label")), " ").alias("words")
    )


@query
def fuzzy_ratio(spark, sf_dir):
    pairs = views.label_pairs(spark, sf_dir).select("actual", "predicted").distinct()
    ratio = matching.fuzzy_ratio(F.lower("actual"), F.lower("predicted"))
    return pairs.withColumn("ratio", ratio)


@query
def compare_labels(spark, sf_dir):
    return matching.with_matches(views.label_pairs(spark, sf_dir)).select(
        "p_partkey", "base_match", "tuned_match"
    )


# --- scores and pixels ----------------------------------------------------------------


@query
def batch_predict(spark, sf_dir):
    predicted = scoring.predict(views.scores(spark, sf_dir))
    return _rounded(predicted.select("vec_id", "predicted_id", "confidence"), "confidence")


def _evaluation(spark, sf_dir) -> DataFrame:
    return _rounded(
        scoring.evaluate(views.scores(spark, sf_dir)), "accuracy", "top_k_accuracy", "cross_entropy"
    )


@query
def eval_accuracy(spark, sf_dir):
    return _evaluation(spark, sf_dir).select("accuracy")


@query
def eval_top5(spark, sf_dir):
    return _evaluation(spark, sf_dir).select(F.col("top_k_accuracy").alias("top_5_accuracy"))


@query
def eval_xent(spark, sf_dir):
    return _evaluation(spark, sf_dir).select("cross_entropy")


@query
def training_metrics(spark, sf_dir):
    """Rows for the training metrics table, one per version."""
    s, label = F.col("scores"), F.col("label")
    rows = (
        views.scores(spark, sf_dir)
        .groupBy(F.concat(F.lit("v3_"), (F.col("vec_id") % 12).cast("string")).alias("model_version"))
        .agg(
            F.avg(vectors.is_top_1(s, label).cast("double")).alias("accuracy"),
            F.avg(vectors.is_top_k(s, label).cast("double")).alias("top_k_accuracy"),
        )
    )
    return _rounded(rows, "accuracy", "top_k_accuracy")


@query
def centroid_predict(spark, sf_dir):
    rows = views.table(spark, sf_dir, "embeddings")
    return scoring.nearest_centroid(rows, scoring.centroids(rows)).select("vec_id", "predicted_id")


@query
def scale_pixels(spark, sf_dir):
    scaled = views.table(spark, sf_dir, "embeddings").select(
        "vec_id",
        vectors.to_unit_range(F.transform("embedding", lambda x: x.cast("double"))).alias("px"),
    )
    return _rounded(
        scaled.select("vec_id", F.array_min("px").alias("min_v"), F.array_max("px").alias("max_v")),
        "min_v",
        "max_v",
    )


# --- sinks: written, read back -----------------------------------------------------------


@query
def write_distribution_once(spark, sf_dir):
    """A run that is appended again replaces its own rows."""
    target = fresh_path(spark, "distribution")
    delete_on_exit(spark, target)
    rows = views.class_distribution(spark, sf_dir).withColumn(
        "run_timestamp", paths.as_utc(F.col("run_timestamp"))
    )
    for _ in range(2):
        sinks.append_distribution(rows, target, RUN_AT)
    return tables.read_distribution(spark, target).withColumn(
        "run_timestamp", F.col("run_timestamp").cast("timestamp_ntz")
    )


@query
def write_distribution(spark, sf_dir):
    """A retried append stores every row twice; the newest row per class is still right."""
    target = fresh_path(spark, "distribution")
    rows = views.class_distribution(spark, sf_dir).withColumn(
        "run_timestamp", paths.as_utc(F.col("run_timestamp"))
    )
    sinks.append_distribution(rows, target)
    sinks.append_distribution(rows, target)
    return metrics.latest_distribution(tables.read_distribution(spark, target)).select(
        "model_version",
        "class_label",
        "label_id",
        "example_count",
        F.col("run_timestamp").cast("timestamp_ntz").alias("run_timestamp"),
    )


@query
def write_predictions(spark, sf_dir):
    target = fresh_path(spark, "predictions")
    log = views.prediction_metrics(spark, sf_dir)
    sinks.append_predictions(log.withColumn("timestamp", paths.as_utc(F.col("ts"))), target)
    stored = tables.read_metrics(spark, target)
    return _rounded(stored, "latency", "confidence").withColumn(
        "timestamp", F.col("timestamp").cast("timestamp_ntz")
    )


@query
def write_predictions_mixed(spark, sf_dir):
    """One log fed by a job, a stream's batches and a batch that is tried again."""
    target = fresh_path(spark, "predictions")
    log = views.prediction_metrics(spark, sf_dir)
    log = log.withColumn("timestamp", paths.as_utc(F.col("ts")))
    part = F.col("event_id") % 3
    sinks.append_predictions(log.filter(part == 0), target)
    for batch in (1, 2, 2):
        sinks.write_prediction_batch(log.filter(part == batch), target, "stream", batch)
    stored = tables.read_metrics(spark, target)
    return _rounded(stored, "latency", "confidence").withColumn(
        "timestamp", F.col("timestamp").cast("timestamp_ntz")
    )


@query
def write_routed(spark, sf_dir):
    target = fresh_path(spark, "routed")
    log = views.prediction_metrics(spark, sf_dir).withColumn("ts", paths.as_utc(F.col("ts")))
    sinks.write_routed(scoring.routed(log), target)
    return spark.read.parquet(target).select(
        "model_version", "outcome", "image_path", "label_path", "label_json"
    )


@query
def write_label_map(spark, sf_dir):
    target = fresh_path(spark, "label-map-document")
    sinks.save_label_map(views.label_map(spark, sf_dir), target)
    return tables.read_label_map(spark, target)


@query
def write_dataset_size(spark, sf_dir):
    root = fresh_path(spark, "size")
    size = curation.dataset_size(_counted(spark, sf_dir))
    return tables.read_dataset_size(spark, sinks.write_dataset_size(size, root, CURRENT))


@query
def write_listing(spark, sf_dir):
    target = fresh_path(spark, "listing")
    listed = objects.list_json(
        views.label_objects(spark, sf_dir).select(F.col("label_path").alias("path"))
    )
    sinks.save_listing(listed, target)
    return spark.read.text(target).withColumnRenamed("value", "path")


@query
def write_training_metrics(spark, sf_dir):
    target = fresh_path(spark, "training-metrics")
    sinks.append_training_metrics(training_metrics(spark, sf_dir), target)
    return spark.read.schema(schemas.TRAINING_METRICS).parquet(target)


@query
def promotion_state(spark, sf_dir):
    """Judge the log, save the next state document, read the newest one back."""
    folder = fresh_path(spark, "state")
    slot = "struct<model_version:string,deployed_at:string>"
    first = spark.range(1).select(
        F.struct(F.lit(CHAMPION), F.lit("2024-01-01T00:00:00Z")).cast(slot).alias("champion"),
        F.struct(F.lit(CURRENT), F.lit(None).cast("string")).cast(slot).alias("challenger"),
    )
    sinks.save_state(first, folder, "20240101-000000")
    jobs.promote(
        spark,
        views.prediction_metrics(spark, sf_dir),
        folder,
        "20240201-000000",
        "2024-02-01T00:00:00Z",
    )
    return tables.read_state(spark, folder).select(
        F.col("champion.model_version").alias("champion"),
        F.col("champion.deployed_at").alias("champion_since"),
        F.col("challenger.model_version").alias("challenger"),
        F.col("challenger.deployed_at").alias("challenger_since"),
    )


@query
def prediction_log(spark, sf_dir):
    """Score, decode, compare and append in one job; class names stand for the true labels."""
    label_map = views.stored_label_map(spark, sf_dir)
    vec = F.col("vec_id")
    truth = label_map.select(F.col("class_name").alias("actual"), F.col("label_id").alias("label"))
    scored = (
        views.scores(spark, sf_dir)
        .join(truth, "label")
        .select(
            vec.alias("event_id"),
            F.timestamp_seconds(vec + 1_700_000_000).alias("ts"),
            F.concat(F.lit("v3_"), (vec % 2).cast("string")).alias("model_version"),
            "actual",
            (vec % 7 / F.lit(100.0)).alias("latency"),
            "scores",
        )
    )
    target = fresh_path(spark, "prediction-log")
    jobs.score_and_log(scored, label_map, target)
    stored = tables.read_metrics(spark, target).withColumn(
        "timestamp", F.col("timestamp").cast("timestamp_ntz")
    )
    return _rounded(stored, "latency", "confidence")


# --- streams --------------------------------------------------------------------------


def _event_stream(spark, sf_dir) -> DataFrame:
    """The table's files as a stream; a glob, since a stream starts from a folder or a glob."""
    schema = views.table(spark, sf_dir, "events").schema
    return views.prediction_log(streams.read_stream(spark, f"{sf_dir}/events[.]parquet", schema))


def _run(query_) -> None:
    query_.awaitTermination()


@query
def stream_ingest(spark, sf_dir):
    log = _event_stream(spark, sf_dir)
    target = fresh_path(spark, "ingest")
    _run(streams.append_to(log, target, fresh_path(spark, "ingest-state")))
    return _rounded(spark.read.schema(log.schema).parquet(target), "latency", "confidence")


# The log arrives by thirds of the month.
_THIRD = "case when day(ts) <= 10 then 0 when day(ts) <= 20 then 1 else 2 end"


def _deliver(spark, sf_dir, start: Callable, again: bool = False, stragglers: bool = False) -> None:
    """Let the log arrive batch by batch in a folder and run the stream after each arrival.

    With ``again`` every row arrives a second time in the batch after its own,
    with ``stragglers`` one in forty arrives in that batch only.
    """
    late = " + case when event_id % 40 = 7 then 1 else 0 end" if stragglers else ""
    log = views.prediction_log(views.table(spark, sf_dir, "events")).withColumn("arrival", F.expr(_THIRD + late))
    folder = fresh_path(spark, "arrivals")
    delete_on_exit(spark, folder)
    for number in range(3 + (again or stragglers)):
        here = F.col("arrival") == number
        arriving = log.where(here | (F.col("arrival") == number - 1) if again else here).drop("arrival")
        arriving.write.mode("append").parquet(folder)
        _run(start(streams.read_stream(spark, folder, arriving.schema)))


@query
def stream_dedup(spark, sf_dir):
    """Every row is delivered twice, in two batches, and kept once."""
    target, state = fresh_path(spark, "dedup"), fresh_path(spark, "dedup-state")
    # the watermark is behind the whole month, so that every repeat is recognised
    once = lambda log: streams.append_to(streams.deduplicated(log, "event_id", delay="40 days"), target, state)
    _deliver(spark, sf_dir, once, again=True)
    kept = spark.read.parquet(target)
    return _rounded(kept, "latency", "confidence").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query
def stream_window_metrics(spark, sf_dir):
    """Windows over several batches, each of which changes some."""
    target, state, keys = fresh_path(spark, "windows"), fresh_path(spark, "windows-state"), ["window_start", "model_version"]
    schemas_ = []

    def start(log):
        rows = streams.windowed(log)
        schemas_.append(rows.schema)
        return streams.upsert_at(rows, target, state, keys, compact_every=3)

    _deliver(spark, sf_dir, start)
    newest = streams.read_upserted(spark, target, schemas_[0], keys)
    return _rounded(newest, "accuracy", "avg_latency").withColumn(
        "window_start", F.col("window_start").cast("timestamp_ntz")
    )


@query
def stream_late_rows(spark, sf_dir):
    """Rows of each window that came in time, and those that came after it had ended."""
    target, state = fresh_path(spark, "late-windows"), fresh_path(spark, "late-windows-state")
    _deliver(spark, sf_dir, lambda log: streams.windows_at(log, target, state, compact_every=3), stragglers=True)
    log = streams.event_time(views.prediction_log(views.table(spark, sf_dir, "events")))
    late = streams.read_late(spark, target, log.schema)
    keys = ["window_start", "model_version"]
    day = F.date_trunc("day", F.col("ts")).alias("window_start")
    counted = late.groupBy(day, "model_version").agg(F.count("*").alias("n_late"))
    both = streams.read_windows(spark, target).join(counted, keys, "full")
    return _rounded(both, "accuracy").select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        "model_version",
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
        "accuracy",
        F.coalesce("n_late", F.lit(0)).cast("bigint").alias("n_late"),
    )


@query
def stream_running_accuracy(spark, sf_dir):
    rows = streams.running_accuracy(_event_stream(spark, sf_dir))
    target = fresh_path(spark, "running")
    _run(streams.replace_at(rows, target, fresh_path(spark, "running-state")))
    return _rounded(streams.read_latest(spark, target), "avg_prediction_accuracy")


# --- images ---------------------------------------------------------------------------


@query
def augment_pixels(spark, sf_dir):
    """Embeddings seen as small images, augmented; the pixels as hexadecimal text."""
    rows = views.table(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.lit(8).alias("height"),
        F.lit(8).alias("width"),
        F.lit(1).alias("n_channels"),
        views.as_image(F.col("embedding")).alias("image"),
    )
    return images.augment(rows, "vec_id", 42).withColumn("image", F.lower(F.hex("image")))


# --- stored objects -------------------------------------------------------------------------


def _stored_tree(spark, sf_dir) -> str:
    """The object tree as single objects below the shared folder."""
    root = fresh_path(spark, "object-tree")
    delete_on_exit(spark, root)
    # dealt out by path: rows are small, so their number in a task counts, not their bytes
    dealt = views.stored_objects(spark, sf_dir).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path")
    object_store.write_objects(dealt, root)
    return root


@query
def list_stored_objects(spark, sf_dir):
    """Images of the current and earlier versions, listed by the tasks from a stored tree."""
    root = _stored_tree(spark, sf_dir)
    listed = objects.list_objects(spark, root, "v3_*", (paths.INCORRECT,))
    current = replay.current_images(listed, CURRENT).withColumn("kind", F.lit("current"))
    earlier = replay.earlier_images(listed, CURRENT).withColumn("kind", F.lit("earlier"))
    return current.unionByName(earlier).select("path", "kind")


@query
def discover_objects(spark, sf_dir):
    """Everything a glob finds in one version's folders, with sizes."""
    found = objects.discover(spark, f"{_stored_tree(spark, sf_dir)}/v3_[3-4]/*", "*[gn]")
    return found.select(objects.relative(F.col("path")).alias("path"), "length")


@query
def preprocess_job(spark, sf_dir):
    """The whole job from stored objects: examples with their pixels, and the quarantine."""
    root = _stored_tree(spark, sf_dir)
    statistics = fresh_path(spark, "distribution")
    done = jobs.preprocess(spark, root, CURRENT, RUN_AT, statistics)
    delete_on_exit(spark, statistics)
    examples = tables.read_stored_examples(spark, done.examples).withColumn("reason", F.lit("none"))
    lost = tables.read_quarantine(spark, done.quarantine).withColumn("image", F.lit(None).cast("binary"))
    columns = ["path", "reason", "filename", "class_name", "label", "image"]
    rows = examples.select(*columns).unionByName(lost.select(*columns))
    return rows.withColumn("image", F.lower(F.hex("image")))
