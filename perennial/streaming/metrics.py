"""Prediction log as a stream: ingest, dedupe, windowed and running accuracy.

Results that batches keep up to date lie in ``batch=`` folders, see
``sources.batches``; every so many batches the finished ones are merged.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from perennial.functions import paths
from perennial.sources import batches


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 1000
) -> DataFrame:
    """Parquet files of a folder or glob as they arrive, so many files in a batch at most."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their keyed state in RocksDB on a cluster.

    The default store keeps it on the heap. A provider that the session names is
    left as it is, and so is that of a checkpoint, which Spark remembers. A
    stream runs in a copy of the session, so the setting need not outlast its start.
    """
    # masters that start with "local", local-cluster too, run on one machine and keep Spark's default
    if spark.conf.get("spark.master", "local").startswith("local") or spark.conf.get(_PROVIDER, None):
        yield
        return
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(_PROVIDER)


def event_time(log: DataFrame, at: str = "ts") -> DataFrame:
    """Watermarks need a timestamp with a zone; the log's zone-less times are UTC."""
    if log.schema[at].dataType == T.TimestampNTZType():
        return log.withColumn(at, paths.as_utc(F.col(at)))
    return log


def deduplicated(log: DataFrame, key: str, at: str = "ts", delay: str = "1 hour") -> DataFrame:
    """Drop repeats of a row that arrive within the delay; state is dropped behind it."""
    return event_time(log, at).withWatermark(at, delay).dropDuplicatesWithinWatermark([key])


def windowed(
    log: DataFrame, at: str = "ts", window: str = "1 day", delay: str = "1 hour"
) -> DataFrame:
    """Volume, accuracy and latency per window and version."""
    return (
        event_time(log, at)
        .withWatermark(at, delay)
        .groupBy(F.window(at, window).alias("w"), "model_version")
        .agg(
            F.count("*").alias("n"),
            F.avg(F.col("is_correct").cast("int")).alias("accuracy"),
            F.avg("latency").alias("avg_latency"),
        )
        .select(
            F.col("w.start").alias("window_start"), "model_version", "n", "accuracy", "avg_latency"
        )
    )


def running_accuracy(log: DataFrame) -> DataFrame:
    """Accuracy so far per version, missing verdicts ignored; state is one row per version."""
    return log.groupBy("model_version").agg(
        F.avg(F.col("is_correct").cast("int")).alias("avg_prediction_accuracy")
    )


def append_to(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what has arrived to a Parquet folder, each row exactly once."""
    with state_on_disk(rows.sparkSession):
        return (
            rows.writeStream.format("parquet")
            .option("path", path)
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )


# Batches after which finished ones are merged.
COMPACT_EVERY = 20


def upsert_at(
    rows: DataFrame, path: str, checkpoint: str, keys: list[str], compact_every: int = COMPACT_EVERY
) -> StreamingQuery:
    """Keep a keyed result up to date: each batch stores the rows it changed, open windows too.

    Merging keeps the newest row of every key only.
    """

    def newest(stored: DataFrame) -> DataFrame:
        return _newest(stored, keys)

    def write(batch: DataFrame, batch_id: int) -> None:
        _write_batch(batch, path, batch_id)
        _merge_some(batch.sparkSession, path, batch_id, compact_every, batch.schema, newest)

    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .outputMode("update")
        .trigger(availableNow=True)
        .start()
    )


def read_upserted(spark: SparkSession, path: str, schema: T.StructType, keys: list[str]) -> DataFrame:
    """The newest row of every key written by :func:`upsert_at`."""
    return _newest(_stored(spark, path, schema), keys)


def replace_at(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keep a complete result up to date, one folder per batch, so a retry only rewrites its own.

    Results but the last few are deleted: a reader that began with one can end with it.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        _write_batch(batch, path, batch_id)
        batches.drop(batch.sparkSession, path, [str(batch_id - 3 - k) for k in range(3)])

    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .outputMode("complete")
        .trigger(availableNow=True)
        .start()
    )


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """The result of the newest batch written by :func:`replace_at`."""
    stored = spark.read.parquet(path)
    newest = stored.agg(F.max("batch")).scalar()
    return stored.filter(F.col("batch") == newest).drop("batch")


def _write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    named = T.StructType([f for f in schema.fields if f.name != "batch"] + [T.StructField("batch", T.StringType())])
    return spark.read.schema(named).parquet(path).where(batches.live(spark, path))


def _newest(stored: DataFrame, keys: list[str]) -> DataFrame:
    others = [c for c in stored.columns if c not in (*keys, "batch")]
    newest = stored.groupBy(*keys).agg(F.max_by(F.struct(*others), batches.number(F.col("batch"))).alias("row"))
    return newest.select(*keys, *[F.col("row")[c].alias(c) for c in others])


def _merge_some(spark, path: str, batch_id: int, every: int, schema: T.StructType, merge) -> None:
    if every and batch_id % every == every - 1:
        batches.compact(spark, path, lambda: _stored(spark, path, schema), merge=merge)


# Sums of a window's rows, which add up over batches.
_SUMS = "window_start timestamp, model_version string, n bigint, n_known bigint, n_correct bigint, latency double, n_latency bigint"


def windows_at(
    log: DataFrame,
    path: str,
    checkpoint: str,
    at: str = "ts",
    window: str = "1 day",
    delay: str = "1 hour",
    compact_every: int = COMPACT_EVERY,
) -> StreamingQuery:
    """Keep windowed sums up to date and late rows apart, so that no row is lost unseen.

    A batch's watermark is the newest time of all earlier batches less the
    delay. Rows whose window ended before it are late: they go to ``path/late``
    as they are. The others leave their windows' sums in ``path/sums``; the
    newest times are kept in ``path/newest``. All three lie in folders by batch,
    which a retried batch writes again, and the watermark looks at earlier
    batches only, so a retry divides the rows the same way. Nothing is kept in
    memory between batches. Rows without a time are late.
    """
    log = event_time(log, at)
    rows_of = {f: f"{path}/{f}" for f in ("sums", "late", "newest")}
    newest_schema = T.StructType([T.StructField("newest", T.TimestampType())])

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        mark = None
        if batch_id:
            earlier = _stored(spark, rows_of["newest"], newest_schema).where(batches.number(F.col("batch")) < batch_id)
            mark = earlier.agg(F.max(F.col("newest") - F.expr(f"interval {delay}"))).first()[0]
        # a window leaves rows without a time out, so those are taken first
        placed = batch.withColumn("w_", F.window(at, window))
        open_ = F.lit(True) if mark is None else F.col("w_.end") > F.lit(mark)
        late = batch.where(F.col(at).isNull()).unionByName(placed.where(~open_).drop("w_"))
        _write_batch(late, rows_of["late"], batch_id)
        sums = placed.where(open_).groupBy(F.col("w_.start").alias("window_start"), "model_version").agg(
            F.count("*").alias("n"),
            F.count("is_correct").alias("n_known"),
            F.count_if("is_correct").alias("n_correct"),
            F.sum("latency").alias("latency"),
            F.count("latency").alias("n_latency"),
        )
        _write_batch(sums, rows_of["sums"], batch_id)
        _write_batch(batch.agg(F.max(at).alias("newest")), rows_of["newest"], batch_id)
        schema = T.StructType.fromDDL(_SUMS)
        _merge_some(spark, rows_of["sums"], batch_id, compact_every, schema, _added)
        _merge_some(spark, rows_of["newest"], batch_id, compact_every, newest_schema, lambda r: r.agg(F.max("newest").alias("newest")))

    return (
        log.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _added(sums: DataFrame) -> DataFrame:
    parts = ("n", "n_known", "n_correct", "latency", "n_latency")
    return sums.groupBy("window_start", "model_version").agg(*[F.sum(c).alias(c) for c in parts])


def read_windows(spark: SparkSession, path: str) -> DataFrame:
    """Volume, accuracy and latency per window and version, as :func:`windows_at` has them."""
    added = _added(_stored(spark, f"{path}/sums", T.StructType.fromDDL(_SUMS)))
    return added.select(
        "window_start",
        "model_version",
        "n",
        F.try_divide("n_correct", "n_known").alias("accuracy"),
        F.try_divide("latency", "n_latency").alias("avg_latency"),
    )


def read_late(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows that came after their window had ended."""
    return _stored(spark, f"{path}/late", schema).drop("batch")
