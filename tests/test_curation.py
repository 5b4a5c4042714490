"""Replay, pairing, examples, statistics and the vocabulary."""

import pytest
from pyspark.sql import functions as F

from perennial import schemas
from perennial.operators import curation, replay, vocabulary
from perennial.plans import jobs


def objects_of(spark, paths):
    return spark.createDataFrame([(p,) for p in paths], "path string")


def label_map_of(spark, mapping):
    return spark.createDataFrame(list(mapping.items()), schemas.LABEL_MAP)


def labels_of(spark, docs):
    return spark.createDataFrame(list(docs.items()), "label_path string, value string")


def wrong(version, n, label="pug"):
    return [f"{version}/incorrect_predictions/{label}_{i}.jpg" for i in range(n)]


def test_earlier_versions(spark):
    names = ["v3_2", "v3_9", "v3_10", "v30_1", "v3_x", "v3_2_bak"]
    objects = objects_of(spark, [f"{v}/incorrect_predictions/a_1.jpg" for v in names] * 2)
    found = replay.earlier_versions(objects, "v3_10").collect()
    assert sorted(tuple(r) for r in found) == [("v3_2", 2), ("v3_2_bak", 2), ("v3_9", 9)]


def test_replay_sizes(spark):
    objects = objects_of(spark, wrong("v3_1", 4) + wrong("v3_2", 5) + wrong("v3_3", 14) + wrong("v3_4", 9))
    sample = replay.replay_sample(objects, "v3_4").groupBy("version").count().collect()
    assert {r.version: r["count"] for r in sample} == {"v3_2": 1, "v3_3": 2}


def test_training_paths(spark):
    extra = ["v3_4/correct_predictions/a_1.jpg", "v3_4/incorrect_predictions/a_1.png", "v3_5/incorrect_predictions/z_1.jpg"]
    objects = objects_of(spark, wrong("v3_3", 10) + wrong("v3_4", 3) + extra)
    got = replay.training_paths(objects, "v3_4")
    assert {r.origin: r["count"] for r in got.groupBy("origin").count().collect()} == {"current": 3, "replay": 2}
    both = replay.training_paths(objects, "v3_4", outcomes=("correct_predictions", "incorrect_predictions"))
    assert both.filter("origin = 'current'").count() == 4


def test_pooled_sample_takes_versions_together(spark):
    objects = objects_of(spark, wrong("v3_1", 4) + wrong("v3_2", 4) + wrong("v30_1", 2) + wrong("v3_4", 9))
    assert replay.pooled_replay_sample(objects, "v3", "v3_4").count() == 2


def test_list_by_prefix_lists_overlaps_twice(spark):
    objects = objects_of(spark, ["v3_0/a/x.jpg", "v3_0/a/b/y.jpg", "v3_1/a/z.jpg", "v3_0/a/n.png"])
    got = replay.list_by_prefix(objects, ["v3_0/a/", "v3_0/a/b/"]).collect()
    assert sorted((r.prefix, r.path) for r in got) == [
        ("v3_0/a/", "v3_0/a/b/y.jpg"), ("v3_0/a/", "v3_0/a/x.jpg"), ("v3_0/a/b/", "v3_0/a/b/y.jpg"),
    ]


@pytest.fixture()
def case(spark):
    images = objects_of(spark, [f"v3_1/incorrect_predictions/{n}.jpg" for n in ("ok_1", "ok_2", "none_1", "bad_1", "empty_1", "odd_1")])
    doc = '{"model_label": "m", "api_label": "%s"}'
    stem = "v3_1/incorrect_predictions/"
    labels = labels_of(spark, {
        stem + "ok_1_labels.json": doc % "pug",
        stem + "ok_2_labels.json": doc % "akita",
        stem + "bad_1_labels.json": "{bad",
        stem + "empty_1_labels.json": '{"model_label": "m"}',
        stem + "odd_1_labels.json": doc % "wolf",
    })
    return images, labels, label_map_of(spark, {"pug": 0, "akita": 1})


def test_examples(case):
    images, labels, label_map = case
    got = curation.examples(curation.pair(images, labels), label_map).collect()
    assert sorted((r.filename, r.class_name, r.label_id) for r in got) == [("ok_1", "pug", 0), ("ok_2", "akita", 1)]


def test_every_lost_image_has_a_reason(case):
    lost = curation.quarantine(*case).collect()
    assert {r.path.rsplit("/", 1)[1]: r.reason for r in lost} == {
        "none_1.jpg": "missing_label", "bad_1.jpg": "bad_json",
        "empty_1.jpg": "no_api_label", "odd_1.jpg": "unknown_label",
    }
    counts = {r.reason: r.n for r in curation.quarantine_counts(*case).collect()}
    assert counts == {"missing_label": 1, "bad_json": 1, "no_api_label": 1, "unknown_label": 1}


def test_size_equals_sum_of_class_counts(case):
    images, labels, label_map = case
    counted = curation.labels_counted(curation.pair(images, labels), label_map)
    size = curation.dataset_size(counted).first().dataset_size
    rows = curation.class_distribution(counted, "v1", "2024-01-01").collect()
    assert size == sum(r.example_count for r in rows) == 2
    assert {r.model_version for r in rows} == {"v1"}
    assert len({r.run_timestamp for r in rows}) == 1


def test_empty_input_counts_zero(spark, case):
    images, labels, label_map = case
    counted = curation.labels_counted(curation.pair(images.limit(0), labels), label_map)
    assert curation.dataset_size(counted).first().dataset_size == 0


def test_statistics_rows(spark):
    counted = spark.createDataFrame(
        [("pitbull", 0, 120), ("doberman", 1, 80)], "class_name string, label_id int, example_count long"
    )
    rows = curation.class_distribution(counted, "v1", "2024-01-01 00:00:00").drop("run_timestamp")
    assert sorted(tuple(r) for r in rows.collect()) == [("v1", "doberman", 1, 80), ("v1", "pitbull", 0, 120)]


def test_training_set_ignores_labels_of_other_versions(spark):
    label_map = label_map_of(spark, {"pug": 0})
    images = wrong("v3_3", 10) + wrong("v3_4", 3) + wrong("v3_5", 2)
    doc = '{"api_label": "pug"}'
    labels = labels_of(spark, {p.replace(".jpg", "_labels.json"): doc for p in images})
    got = jobs.build_training_set(objects_of(spark, images), labels, label_map, "v3_4").collect()
    assert sum(r.origin == "current" for r in got) == 3
    assert sum(r.origin == "replay" for r in got) == 2
    assert {r.path.split("/")[0] for r in got} == {"v3_3", "v3_4"}


def test_new_labels_get_the_next_ids(spark):
    known = label_map_of(spark, {"a": 0, "b": 1})
    files = objects_of(spark, [f"incorrect_predictions/{x}_1_labels.json" for x in "bdcd"])
    updated = vocabulary.extend(known, vocabulary.new_labels(files, known))
    mapping = {r.class_name: r.label_id for r in updated.collect()}
    assert mapping == {"a": 0, "b": 1, "c": 2, "d": 3}
    again = vocabulary.extend(updated, vocabulary.new_labels(files, updated))
    assert {r.class_name: r.label_id for r in again.collect()} == mapping


def test_gaps_in_ids_do_not_collide(spark):
    known = label_map_of(spark, {"a": 0, "b": 7})
    fresh = spark.createDataFrame([("c",)], "class_name string")
    assert {r.class_name: r.label_id for r in vocabulary.extend(known, fresh).collect()}["c"] == 8
    empty = known.limit(0)
    assert vocabulary.extend(empty, fresh).first().label_id == 0


def test_vocabulary_documents(spark):
    known = label_map_of(spark, {"pug": 1, "german shepherd": 0})
    document = vocabulary.to_json(known)
    assert document.first().value == '{"german shepherd":0,"pug":1}'
    assert sorted(tuple(r) for r in vocabulary.from_json(document).collect()) == [("german shepherd", 0), ("pug", 1)]
    csv = spark.createDataFrame([("pug \r\n german shepherd\nakita\n",)], "value string")
    assert [tuple(r) for r in vocabulary.from_csv(csv).collect()] == [("pug", 0), ("german shepherd", 1), ("akita", 2)]


def test_inverse_map_rejects_a_shared_id(spark):
    assert vocabulary.names_of(label_map_of(spark, {"a": 0, "b": 1})).count() == 2
    with pytest.raises(Exception, match="label id used twice"):
        vocabulary.names_of(label_map_of(spark, {"a": 0, "b": 0})).collect()


def test_required_columns_stop_the_job(spark):
    rows = spark.createDataFrame(
        [("v1", None, 0, 1)], "model_version string, class_label string, label_id int, example_count int"
    ).withColumn("run_timestamp", F.current_timestamp())
    with pytest.raises(Exception, match="required column class_label is null"):
        schemas.conform(rows, schemas.CLASS_DISTRIBUTION).collect()
