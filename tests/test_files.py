"""Object trees, images and stored tables on real files."""

import json
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from perennial import schemas
from perennial.functions import paths
from perennial.operators import images, replay, scoring
from perennial.plans import jobs
from perennial.sources import object_store, objects, sinks, tables


def png(width, height, rgb, alpha=None, gray=False):
    pixel = bytes(rgb) if alpha is None else bytes(rgb) + bytes([alpha])
    kind = 2 if alpha is None else 6
    if gray:
        pixel, kind = bytes(rgb[:1]), 0
    raw = (b"\0" + pixel * width) * height

    def chunk(tag, data):
        return struct.pack(">I", len(data)) + tag + data + struct.pack(">I", zlib.crc32(tag + data))

    head = struct.pack(">IIBBBBB", width, height, 8, kind, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


@pytest.fixture()
def tree(tmp_path):
    """Two versions; 10 older images, 4 current ones of which one is broken and one unlabeled."""
    root = tmp_path / "bucket"

    def put(path, data):
        target = root / path
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(data)

    def image(stem, label, data=None):
        put(stem + ".jpg", data or png(3, 2, (10, 20, 30)))
        if label:
            put(stem + "_labels.json", json.dumps({"model_label": "x", "api_label": label}).encode())

    for i in range(10):
        image(f"v3_1/incorrect_predictions/pug_{i}", "pug")
    image("v3_2/incorrect_predictions/german shepherd_1", "german shepherd")
    image("v3_2/incorrect_predictions/pug+akita_2", "pug")
    image("v3_2/incorrect_predictions/pug_3", "pug", b"not an image")
    image("v3_2/incorrect_predictions/pug_4", None)
    image("v3_2/correct_predictions/pug_5", "pug")
    image("v30_1/incorrect_predictions/pug_6", "pug")
    put("processed/metadata/label_map.json", json.dumps({"pug": 0, "german shepherd": 1}, indent=2).encode())
    return str(root)


def test_listing(spark, tree):
    listed = objects.list_objects(spark, tree, "v3_*")
    found = {r.path for r in listed.select("path").collect()}
    assert "v3_2/incorrect_predictions/german shepherd_1.jpg" in found
    assert "v3_2/incorrect_predictions/pug+akita_2.jpg" in found
    assert not any(p.startswith("v30") or p.startswith("processed") for p in found)
    current = replay.current_images(listed, "v3_2")
    assert current.count() == 4
    assert replay.replay_sample(listed, "v3_2").count() == 2


def test_json_listing_and_cap(spark, tree, tmp_path):
    listed = objects.list_objects(spark, tree)
    everything = objects.list_json(listed)
    assert everything.count() == 15
    assert objects.list_json(listed, 0).count() == 15
    assert objects.list_json(listed, 3).count() == 3
    sinks.save_listing(everything, str(tmp_path / "listing"))
    assert spark.read.text(str(tmp_path / "listing")).count() == 15


def test_tasks_list_many_objects(spark, tmp_path):
    for version in range(5):
        folder = tmp_path / f"v3_{version}" / "incorrect_predictions"
        (folder / "deep er").mkdir(parents=True)
        for i in range(1990):
            (folder / f"a+b {i}.jpg").touch()
        for i in range(10):
            (folder / "deep er" / f"{i}.jpg").write_bytes(b"x" * i)
        (folder / ".hidden.jpg").touch()
        (folder / "_SUCCESS").touch()
    (tmp_path / "v4_1").mkdir()
    listed = objects.list_objects(spark, str(tmp_path), "v3_*", ("incorrect_predictions",))
    assert listed.count() == 10_000 and listed.select("path").distinct().count() == 10_000 - 5 * 10 + 10
    plan = listed._jdf.queryExecution().toString()
    assert "FileScan" not in plan and "InMemoryFileIndex" not in plan and listed.inputFiles() == []
    some = objects.discover(spark, f"file://{tmp_path}/v3_{{1,2}}/*", "*7.jpg")
    assert some.count() == 2 * (199 + 1)
    assert some.agg(F.max("length")).first()[0] == 7
    assert objects.discover(spark, str(tmp_path / "v3_1/incorrect_predictions/deep er/3.jpg")).count() == 1
    assert objects.discover(spark, f"{tmp_path}/v4_*/x").count() == 0


def test_written_objects_replace_their_like(spark, tmp_path):
    rows = spark.createDataFrame([("v/a b.jpg", b"1"), ("v/w/c.json", b"22"), ("v/empty", b"")], "path string, content binary")
    for _ in range(2):
        object_store.write_objects(rows, str(tmp_path))
    assert sorted(p.name for p in (tmp_path / "v").rglob("*") if p.is_file()) == ["a b.jpg", "c.json", "empty"]
    assert (tmp_path / "v/w/c.json").read_bytes() == b"22"


def test_glob_report(spark, tree):
    count, shown = objects.glob_report(spark, tree + "/v3_1/*", preview=3)
    assert count == 20
    assert len(shown) == 3
    assert objects.glob_report(spark, tree + "/nothing/*") == (0, [])


def test_label_files(spark, tree):
    docs = objects.read_label_files(spark, tree, "v3_*")
    assert docs.count() == 14
    names = docs.select(paths.label_in_name(F.col("label_path"))).distinct().collect()
    assert {r[0] for r in names} == {"pug", "german shepherd", "pug+akita"}
    assert objects.read_label_files(spark, tree, "v9_*").count() == 0


def test_tasks_of_the_job_do_not_grow_with_small_files(spark, tmp_path):
    folder = tmp_path / "v3_1/incorrect_predictions"
    folder.mkdir(parents=True)
    for i in range(80):
        (folder / f"pug_{i}.jpg").write_bytes(png(3, 2, (10, 20, i)))
        (folder / f"pug_{i}_labels.json").write_text('{"model_label": "x", "api_label": "pug"}')
    (tmp_path / "processed/metadata").mkdir(parents=True)
    (tmp_path / "processed/metadata/label_map.json").write_text('{"pug": 0}')
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("small-files", "small files")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")
    try:
        done = jobs.preprocess(spark, str(tmp_path), "v3_1", "2024-02-01 00:00:00", str(tmp_path / "distribution"))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert tables.read_stored_examples(spark, done.examples).count() == 80
    stages = [s for j in tracker.getJobIdsForGroup("small-files") for s in tracker.getJobInfo(j).stageIds]
    tasks = [found.numTasks for s in stages if (found := tracker.getStageInfo(s))]
    assert tasks and max(tasks) < 80
    assert spark.conf.get("spark.sql.files.openCostInBytes", None) is None


def test_bytes_of_listed_objects(spark, tmp_path):
    stored = {f"{tmp_path}/a b+{i}.json": bytes([i]) * i for i in range(40)}
    for path, content in stored.items():
        with open(path, "wb") as out:
            out.write(content)
    listed = object_store.list_below(spark, str(tmp_path), "*.json")
    assert {r.path: bytes(r.content) for r in object_store.contents(listed).collect()} == stored


def test_decoded_images(spark, tree):
    raw = objects.read_images(spark, tree, "v3_2")
    assert {r.path for r in raw.select("path").collect()} == {
        "v3_2/incorrect_predictions/german shepherd_1.jpg",
        "v3_2/incorrect_predictions/pug+akita_2.jpg",
        "v3_2/incorrect_predictions/pug_4.jpg",
    }
    assert bytes(raw.first().data[:3]) == bytes((30, 20, 10))
    rgb = images.to_rgb(raw).first()
    assert (rgb.height, rgb.width, rgb.n_channels) == (2, 3, 3)
    assert bytes(rgb.image) == bytes((10, 20, 30)) * 6


def test_gray_and_transparent_images_become_rgb(spark, tmp_path):
    folder = tmp_path / "v3_1" / "incorrect_predictions"
    folder.mkdir(parents=True)
    (folder / "gray_1.jpg").write_bytes(png(2, 2, (77, 77, 77), gray=True))
    (folder / "clear_1.jpg").write_bytes(png(2, 2, (1, 2, 3), alpha=128))
    got = {r.path.rsplit("/", 1)[1]: bytes(r.image[:3]) for r in images.to_rgb(objects.read_images(spark, str(tmp_path))).collect()}
    assert got == {"gray_1.jpg": bytes((77, 77, 77)), "clear_1.jpg": bytes((1, 2, 3))}


def test_shape_check(spark, tree):
    rgb = images.to_rgb(objects.read_images(spark, tree, "v3_1"))
    good, bad = images.split_by_shape(rgb, (2, 3, 3))
    assert (good.count(), bad.count()) == (10, 0)
    good, bad = images.split_by_shape(rgb)
    assert (good.count(), bad.count()) == (0, 10)
    assert {r.reason for r in bad.collect()} == {"bad_shape"}


def pixel_rows(spark, n=40):
    rng = np.random.default_rng(3)
    rows = [(i, 20, 30, 3, bytearray(rng.integers(0, 256, 20 * 30 * 3, dtype=np.uint8).tobytes())) for i in range(n)]
    return spark.createDataFrame(rows, "id int, height int, width int, n_channels int, image binary")


def test_augmentation_depends_on_row_and_seed_only(spark):
    rows = pixel_rows(spark)
    one = {r.id: bytes(r.image) for r in images.augment(rows.coalesce(1), "id", 1).collect()}
    many = {r.id: bytes(r.image) for r in images.augment(rows.repartition(7), "id", 1).collect()}
    other = {r.id: bytes(r.image) for r in images.augment(rows, "id", 2).collect()}
    assert one == many
    assert one != other
    assert all(len(v) == 20 * 30 * 3 for v in one.values())


def test_augmentation_stays_within_its_ranges(spark):
    flat = spark.range(50).select(
        "id", F.lit(8).alias("height"), F.lit(8).alias("width"), F.lit(3).alias("n_channels"),
        F.unhex(F.repeat(F.lit("64"), 192)).alias("image"),
    )
    # one flat gray level: only brightness can move it
    levels = {bytes(r.image) for r in images.augment(flat, "id", 5).collect()}
    for image in levels:
        assert len(set(image)) == 1
        assert abs(image[0] - 100) <= 51
    assert len(levels) > 10


def test_preprocessing_job(spark, tree, tmp_path):
    stats = str(tmp_path / "class_distribution")
    done = jobs.preprocess(spark, tree, "v3_2", "2024-01-01 00:00:00", stats)
    examples = tables.read_examples(spark, done.examples).collect()
    current = {r.filename for r in examples if r.path.startswith("v3_2/")}
    assert current == {"german shepherd_1", "pug+akita_2"}
    assert sum(r.path.startswith("v3_1/") for r in examples) == 2
    assert all(bytes(r.image) == bytes((10, 20, 30)) * 6 for r in examples)
    assert tables.read_dataset_size(spark, done.metadata).first().dataset_size == 4
    rows = tables.read_distribution(spark, stats).collect()
    assert {(r.model_version, r.class_label, r.label_id, r.example_count) for r in rows} == {
        ("v3_2", "pug", 0, 3), ("v3_2", "german shepherd", 1, 1),
    }
    lost = {(r.path, r.reason) for r in spark.read.parquet(done.quarantine).collect()}
    assert lost == {
        ("v3_2/incorrect_predictions/pug_3.jpg", "bad_image"),
        ("v3_2/incorrect_predictions/pug_4.jpg", "missing_label"),
    }
    with pytest.raises(ValueError):
        jobs.preprocess(spark, tree, "v3_2/x", "2024-01-01 00:00:00", stats)
    # a second run replaces the examples and appends statistics
    jobs.preprocess(spark, tree, "v3_2", "2024-01-02 00:00:00", stats)
    assert tables.read_examples(spark, done.examples).count() == 4
    assert tables.read_distribution(spark, stats).count() == 4


def test_only_chosen_images_are_opened_and_chosen_once(spark, tree, tmp_path, monkeypatch):
    opened, drawn = [], []
    at, paths_of = objects.read_images_at, replay.training_paths
    monkeypatch.setattr(objects, "read_images_at", lambda s, root, wanted: opened.append(wanted) or at(s, root, wanted))
    monkeypatch.setattr(replay, "training_paths", lambda *a, **b: drawn.append(a) or paths_of(*a, **b))
    done = jobs.preprocess(spark, tree, "v3_2", "2024-01-01 00:00:00", str(tmp_path / "cd"), block=2)
    # the version's three images with a label and two of the ten older ones, in three blocks
    assert len(drawn) == 1 and len(opened) == 3
    wanted = [path for block in opened for path in block]
    assert len(wanted) == len(set(wanted)) == 5 and sum(p.startswith("v3_1/") for p in wanted) == 2
    assert tables.read_examples(spark, done.examples).count() == 4
    assert [r.reason for r in tables.read_quarantine(spark, done.quarantine).orderBy("reason").collect()] == ["bad_image", "missing_label"]


def test_images_with_names_like_patterns(spark, tmp_path):
    names = ["v3_1/incorrect_predictions/" + n for n in ("a[b]*{c}?.jpg", "a\u00e9 b+c.jpg", "broken.jpg", "empty.jpg")]
    rows = list(zip(names, (png(2, 2, (1, 2, 3)), png(2, 2, (1, 2, 3)), b"x", b"")))
    object_store.write_objects(spark.createDataFrame(rows, "path string, content binary"), str(tmp_path))
    found = {r.path: r.height for r in objects.read_images_at(spark, str(tmp_path), names).collect()}
    assert found == dict(zip(names, (2, 2, -1)))
    assert objects.read_images_at(spark, str(tmp_path), []).count() == 0


def test_a_version_without_examples(spark, tree, tmp_path):
    done = jobs.preprocess(spark, tree, "v3_0", "2024-01-01 00:00:00", str(tmp_path / "cd"))
    assert tables.read_dataset_size(spark, done.metadata).first().dataset_size == 0
    assert tables.read_quarantine(spark, done.quarantine).count() == 0
    with pytest.raises(FileNotFoundError):
        tables.read_examples(spark, done.examples)


def test_misshapen_images_reach_the_quarantine(spark, tree, tmp_path):
    label_map = tree + "/processed/metadata/label_map.json"
    done = jobs.preprocess(spark, tree, "v3_2", "2024-01-01 00:00:00", str(tmp_path / "cd"))
    for _ in range(2):
        jobs.training_input(spark, done.examples, label_map, shape=(9, 9, 3))
    lost = tables.read_quarantine(spark, done.quarantine)
    assert {r["reason"]: r["count"] for r in lost.groupBy("reason").count().collect()} == {"bad_image": 1, "missing_label": 1, "bad_shape": 4}
    assert {r.class_name for r in lost.where("reason = 'bad_shape'").collect()} == {"pug", "german shepherd"}


def test_training_input_and_report(spark, tree, tmp_path):
    label_map = tree + "/processed/metadata/label_map.json"
    done = jobs.preprocess(spark, tree, "v3_2", "2024-01-01 00:00:00", str(tmp_path / "cd"))
    train, val, weights = jobs.training_input(spark, done.examples, label_map, 0.3, 2)
    assert (train.count(), val.count()) == (3, 1)
    assert [df.count() for df in jobs.training_input(spark, done.examples, label_map, shape=(2, 3, 3))[:2]] == [3, 1]
    assert [df.count() for df in jobs.training_input(spark, done.examples, label_map, shape=(9, 9, 3))[:2]] == [0, 0]
    assert objects.read_images(spark, tree, "v9_9").count() == 0
    assert sorted(r.batch_id for r in train.collect()) == [0, 0, 1]
    assert {r.label_id for r in weights.collect()} == {0, 1}
    report = jobs.validation_report(spark, done.examples, label_map)
    assert tuple(report["files"].first()) == (4, 4, 0)
    assert [r.label_name for r in report["labels"].collect()] == ["pug", "german shepherd"]
    assert report["duplicates"].count() == 0


def test_examples_read_a_subset_of_columns(spark, tree, tmp_path):
    done = jobs.preprocess(spark, tree, "v3_2", "2024-01-01 00:00:00", str(tmp_path / "cd"))
    assert tables.read_examples(spark, done.examples, ["label"]).columns == ["label"]
    with pytest.raises(FileNotFoundError):
        tables.read_examples(spark, str(tmp_path / "none"))


def test_label_map_files(spark, tree, tmp_path):
    missing = str(tmp_path / "none.json")
    assert tables.read_label_map(spark, missing, strict=False).count() == 0
    with pytest.raises(Exception):
        tables.read_label_map(spark, missing)
    names = tmp_path / "names.csv"
    names.write_text("affenpinscher\nafrican hunting dog \nakita\n")
    got = [tuple(r) for r in tables.read_label_csv(spark, str(names)).collect()]
    assert got == [("affenpinscher", 0), ("african hunting dog", 1), ("akita", 2)]


def test_vocabulary_refresh(spark, tree, tmp_path):
    listing = objects.list_objects(spark, tree, "v3_*")
    old = tree + "/processed/metadata/label_map.json"
    target = str(tmp_path / "label_map")
    updated = jobs.refresh_vocabulary(spark, listing, old, target)
    assert {r.class_name: r.label_id for r in updated.collect()} == {"pug": 0, "german shepherd": 1, "pug+akita": 2}
    assert jobs.refresh_vocabulary(spark, listing, target, str(tmp_path / "again")) is None


def test_scored_rows_are_routed_and_logged(spark, tmp_path):
    rows = [(1, "v3_0", "pug", [0.9, 0.1]), (2, "v3_1", "pug", [0.9, 0.1]), (3, "v3_1", "akita", [0.6, 0.4]), (4, "v3_1", "akita", [0.2, 0.8])]
    scored = spark.createDataFrame(rows, "event_id long, model_version string, actual string, scores array<double>").select(
        "*", F.timestamp_seconds(F.lit(1_700_000_000)).alias("ts"), F.lit(0.5).alias("latency")
    )
    label_map = spark.createDataFrame([("pug", 0), ("akita", 1)], schemas.LABEL_MAP)
    log, routed = str(tmp_path / "log"), str(tmp_path / "routed")
    jobs.score_and_log(scored, label_map, log, routed)
    stored = tables.read_metrics(spark, log)
    assert stored.schema.fieldNames() == schemas.PREDICTION_METRICS.fieldNames()
    assert sorted((r.model_version, r.is_correct, r.confidence) for r in stored.collect()) == [
        ("v3_0", True, 0.9), ("v3_1", False, 0.6), ("v3_1", True, 0.8), ("v3_1", True, 0.9),
    ]
    kept = spark.read.parquet(routed).collect()
    assert {(r.outcome, r.image_path) for r in kept} == {
        ("correct_predictions", "v3_1/correct_predictions/pug_1700000000_2.jpg"),
        ("incorrect_predictions", "v3_1/incorrect_predictions/akita_1700000000_3.jpg"),
        ("correct_predictions", "v3_1/correct_predictions/akita_1700000000_4.jpg"),
    }
    wrong = next(r for r in kept if r.outcome == "incorrect_predictions")
    assert json.loads(wrong.label_json) == {"model_label": "pug", "api_label": "akita"}


def test_scored_stream_logs_each_batch_once(spark, tmp_path):
    schema = "event_id long, ts timestamp, model_version string, actual string, latency double, scores array<double>"
    label_map = spark.createDataFrame([("pug", 0), ("akita", 1)], schemas.LABEL_MAP)
    folder, log, state = str(tmp_path / "in"), str(tmp_path / "log"), str(tmp_path / "state")
    for i in range(2):
        spark.createDataFrame([(i, None, "v3_1", "pug", 0.1, [0.9, 0.1])], schema).write.mode("append").parquet(folder)
        jobs.score_stream(spark.readStream.schema(schema).parquet(folder), label_map, log, state).awaitTermination()
    stored = tables.read_metrics(spark, log)
    assert [r.is_correct for r in stored.collect()] == [True, True]
    assert stored.columns == schemas.PREDICTION_METRICS.fieldNames()


def test_pooled_sample_of_example_files(spark, tmp_path):
    for version, n in (("v3_1", 7), ("v3_2", 4), ("v3_3", 9)):
        spark.range(n).repartition(n).write.option("maxRecordsPerFile", 1).parquet(f"{tmp_path}/processed/{version}/data")
    files = objects.list_example_files(spark, str(tmp_path))
    assert files.groupBy("version").count().count() == 3
    sample = replay.pooled_sample(files, "v3", "v3_3").collect()
    eligible = files.filter("version <> 'v3_3'").count()
    assert len(sample) == int(eligible * 0.2)
    assert {r.version for r in sample} <= {"v3_1", "v3_2"}


def test_training_metrics_row(spark, tmp_path):
    row = {"model_version": "m_net_s_v3.1", "accuracy": 0.85, "top_k_accuracy": 0.95}
    target = str(tmp_path / "training_metrics")
    sinks.append_training_metrics(sinks.one_row(spark, row, schemas.TRAINING_METRICS), target)
    assert [r.asDict() for r in spark.read.parquet(target).collect()] == [row]


def test_one_log_for_jobs_and_streams(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = spark.sql(
        "select timestamp_seconds(id) as timestamp, 'a' as actual, 'a' as predicted, true as is_correct, "
        "0.1D as latency, 0.5D as confidence, concat('v3_', id % 3) as model_version from range(30)"
    )
    sinks.append_predictions(rows, path)
    sinks.append_predictions(rows, path)
    for _ in range(2):
        sinks.write_prediction_batch(rows, path, "stream", 0)
    stored = tables.read_metrics(spark, path)
    assert stored.count() == 90
    one = stored.filter("model_version = 'v3_1'")
    assert one.count() == 30
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(model_version" in plan


def test_routing_counts_a_missing_verdict_as_incorrect(spark):
    df = spark.sql("select 'v3_1' model_version, cast(null as boolean) is_correct, 'a' actual, 'a' predicted, current_timestamp() ts, 1L event_id")
    assert [r.outcome for r in scoring.routed(df).collect()] == ["incorrect_predictions"]


def test_versions_can_have_vocabularies_of_their_own(spark):
    rows = spark.createDataFrame([("v3_0", 0), ("v3_1", 0), ("v3_1", 7)], "model_version string, predicted_id int")
    label_map = spark.createDataFrame([("v3_0", "a", 0), ("v3_1", "b", 0)], "model_version string, class_name string, label_id int")
    got = {(r.model_version, r.predicted_id, r.predicted) for r in scoring.decode(rows, label_map).collect()}
    assert got == {("v3_0", 0, "a"), ("v3_1", 0, "b"), ("v3_1", 7, None)}
