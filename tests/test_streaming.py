"""The prediction log as a stream, against batch results."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from perennial.plans import views
from perennial.session import fresh_path, released, stage
from perennial.sources import batches, sinks, tables
from perennial.streaming import metrics as streams


@pytest.fixture()
def arriving(spark, sf_dir, tmp_path):
    """A folder into which the log arrives in two parts, in time order."""
    log = views.prediction_metrics(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    middle = log.agg(F.expr("percentile_approx(ts, 0.5)")).first()[0]
    folder = str(tmp_path / "log")

    def deliver(first: bool):
        part = log.filter(F.col("ts") <= middle) if first else log.filter(F.col("ts") > middle)
        part.coalesce(1).write.mode("append").parquet(folder)

    return log, folder, deliver


def test_windows_over_two_runs_equal_the_batch(spark, arriving, tmp_path):
    log, folder, deliver = arriving
    target, checkpoint = str(tmp_path / "out"), str(tmp_path / "state")
    for first in (True, False):
        deliver(first)
        rows = streams.windowed(streams.read_stream(spark, folder, log.schema))
        streams.append_to(rows, target, checkpoint).awaitTermination()

    def keyed(df):
        rows = df.withColumn("accuracy", F.round("accuracy", 9)).collect()
        return {(r.window_start, r.model_version): (r.n, r.accuracy) for r in rows}

    batch = keyed(streams.windowed(log))
    newest = max(start for start, _ in batch)
    assert keyed(spark.read.parquet(target)) == {k: v for k, v in batch.items() if k[0] < newest}


def test_every_window_is_there_after_each_batch(spark, arriving, tmp_path):
    log, folder, deliver = arriving
    target, checkpoint = str(tmp_path / "out"), str(tmp_path / "state")
    for part in range(3):
        spark.createDataFrame(log.filter(F.dayofmonth("ts") % 3 == part).collect(), log.schema).coalesce(1).write.mode("append").parquet(folder)
    rows = streams.windowed(streams.read_stream(spark, folder, log.schema, files_per_batch=1), delay="40 days")
    streams.upsert_at(rows, target, checkpoint, ["window_start", "model_version"], compact_every=0).awaitTermination()
    assert len(spark.read.parquet(target).select("batch").distinct().collect()) >= 3
    newest = streams.read_upserted(spark, target, rows.schema, ["window_start", "model_version"])
    assert newest.agg(F.sum("n")).first()[0] == log.count()
    assert newest.count() == streams.windowed(log).count()


def test_running_accuracy_follows_the_log(spark, arriving, tmp_path):
    log, folder, deliver = arriving
    target, checkpoint = str(tmp_path / "out"), str(tmp_path / "state")
    for first in (True, False):
        deliver(first)
        rows = streams.running_accuracy(streams.read_stream(spark, folder, log.schema))
        streams.replace_at(rows, target, checkpoint).awaitTermination()
        so_far = spark.read.parquet(folder)
        expected = {r[0]: round(r[1], 9) for r in streams.running_accuracy(so_far).collect()}
        got = {r[0]: round(r[1], 9) for r in streams.read_latest(spark, target).collect()}
        assert got == expected


def test_a_second_delivery_adds_nothing(spark, arriving, tmp_path):
    log, folder, deliver = arriving
    target, checkpoint = str(tmp_path / "out"), str(tmp_path / "state")
    # the watermark is longer than the log, so late repeats are still recognised
    for _ in range(2):
        deliver(True)
        stream = streams.read_stream(spark, folder, log.schema)
        once = streams.deduplicated(stream, "event_id", delay="60 days")
        streams.append_to(once, target, checkpoint).awaitTermination()
    kept = spark.read.parquet(target)
    assert kept.count() == kept.select("event_id").distinct().count()
    assert spark.read.parquet(folder).count() == 2 * kept.count()


def test_on_a_cluster_repeats_are_dropped_with_state_on_disk(spark, arriving, tmp_path):
    log, folder, deliver = arriving
    target, checkpoint = str(tmp_path / "out"), str(tmp_path / "state")
    provider = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set("spark.master", "spark://elsewhere:7077")
    try:
        for _ in range(2):
            deliver(True)
            once = streams.deduplicated(streams.read_stream(spark, folder, log.schema), "event_id", delay="60 days")
            streams.append_to(once, target, checkpoint).awaitTermination()
    finally:
        spark.conf.unset("spark.master")
    kept = spark.read.parquet(target)
    assert 2 * kept.count() == 2 * kept.select("event_id").distinct().count() == spark.read.parquet(folder).count()
    assert "RocksDB" in spark.read.text(f"{checkpoint}/offsets/0", wholetext=True).first()[0]
    assert spark.conf.get(provider, None) is None


def test_ingest_resumes_from_its_checkpoint(spark, arriving, tmp_path):
    log, folder, deliver = arriving
    target, checkpoint = str(tmp_path / "out"), str(tmp_path / "state")
    for first in (True, False):
        deliver(first)
        streams.append_to(streams.read_stream(spark, folder, log.schema), target, checkpoint).awaitTermination()
    assert spark.read.parquet(target).count() == log.count()


def test_late_rows_are_kept_apart_and_nothing_is_lost(spark, tmp_path):
    folder, target, checkpoint = (str(tmp_path / n) for n in ("log", "out", "state"))
    schema = "ts timestamp, model_version string, is_correct boolean, latency double"
    hours = [[0, 30], [49, 1], [50, 47.5, None], [20, 200], [60, 201]]
    for batch in hours:
        rows = [(None if h is None else datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=h), "v3_1", True, 1.0) for h in batch]
        spark.createDataFrame(rows, schema).write.mode("append").parquet(folder)
        log = streams.read_stream(spark, folder, spark.createDataFrame([], schema).schema)
        streams.windows_at(log, target, checkpoint, compact_every=2).awaitTermination()
    late = streams.read_late(spark, target, log.schema)
    started = datetime.datetime(2024, 1, 1)
    assert sorted((r.ts - started).total_seconds() / 3600 for r in late.where("ts is not null").collect()) == [1, 20, 47.5, 60]
    assert late.where("ts is null").count() == 1
    kept = streams.read_windows(spark, target)
    assert kept.agg(F.sum("n")).first()[0] + late.count() == sum(map(len, hours))
    assert kept.where("accuracy <> 1 or avg_latency <> 1").count() == 0


def test_results_that_batches_replace_stay_few(spark, tmp_path):
    folder, target, checkpoint = (str(tmp_path / n) for n in ("log", "out", "state"))
    for number in range(7):
        spark.createDataFrame([("v3_1", number % 2 == 0)], "model_version string, is_correct boolean").write.mode("append").parquet(folder)
        log = streams.read_stream(spark, folder, spark.read.parquet(folder).schema)
        streams.replace_at(streams.running_accuracy(log), target, checkpoint).awaitTermination()
    assert sorted(p.name for p in (tmp_path / "out").glob("batch=*")) == ["batch=4", "batch=5", "batch=6"]
    assert streams.read_latest(spark, target).first()[1] == 4 / 7


def test_fifty_batches_of_the_log_become_few(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = spark.sql(
        "select timestamp_seconds(id) as timestamp, 'a' as actual, 'a' as predicted, id % 4 > 0 as is_correct, "
        "0.1D as latency, 0.5D as confidence, concat('v3_', id % 2) as model_version from range(8)"
    )
    for number in range(50):
        sinks.write_prediction_batch(rows, path, "s", number)
        if number % 10 == 9:
            assert tables.compact_metrics(spark, path) > 0
    # a retry of the newest batch still replaces itself
    sinks.write_prediction_batch(rows, path, "s", 49)
    before = tables.read_metrics(spark, path)
    assert before.count() == 400 and before.where("is_correct").count() == 300
    assert before.where("model_version = 'v3_1'").count() == 200
    assert len(list((tmp_path / "log").glob("*/batch=*"))) <= 2 * 14
    assert tables.compact_metrics(spark, path) == 0
    assert len(list((tmp_path / "log").glob("*/batch=*"))) == 2 * 3
    assert tables.read_metrics(spark, path).count() == 400


def test_a_merged_batch_counts_by_its_manifest_only(spark, tmp_path):
    path = str(tmp_path / "t")
    for number in range(3):
        spark.range(number + 1).write.parquet(f"{path}/batch={number}")
    read = lambda: spark.read.schema("id bigint, batch string").parquet(path).where(batches.live(spark, path))
    # rows of a merge whose driver was lost before its manifest was written
    batches._commit(spark, path, batches._NONE)
    spark.range(3).write.parquet(f"{path}/batch=merged-1-1")
    assert read().count() == 6 and batches.names(spark, path) == ["0", "1", "2"]
    assert batches.compact(spark, path, read, newest=1) == 2
    assert read().count() == 6 and batches.names(spark, path) == ["2", "merged-1-1"]
    assert batches.compact(spark, path, read, newest=1) == 0


def test_a_batch_takes_what_it_staged_with_it(spark):
    with released(spark):
        staged = stage(spark.range(3), "mine")
        assert staged.count() == 3
        folder = staged.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
        assert os.path.isdir(folder)
    assert not os.path.exists(folder)


def test_paths_below_the_shared_folder_differ(spark):
    assert fresh_path(spark, "x") != fresh_path(spark, "x")
    assert fresh_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
