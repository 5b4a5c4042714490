"""Accuracy rules, statistics, percentiles, drift and schema reports."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perennial.operators import confusion, metrics, quantiles, scoring, training, validation

LOG = "model_version string, actual string, predicted string, is_correct boolean"


def log_of(spark, verdicts, version="v3_1", actual="pug"):
    return spark.createDataFrame([(version, actual, actual, v) for v in verdicts], LOG)


def test_three_null_rules(spark):
    log = log_of(spark, [True, False, None])
    assert metrics.accuracy_by_version(log).first().avg_prediction_accuracy == 0.5
    top = metrics.top_classes_by_accuracy(log, "v3_1").first()
    assert (top.total, top.correct, round(top.accuracy, 6)) == (3, 1, 0.333333)
    assert metrics.class_accuracy(log, "v3_1", "pug").first().accuracy == 33.33


def test_class_accuracy_is_half_even_and_defaults_to_zero(spark):
    log = log_of(spark, [True] + [False] * 31)
    assert metrics.class_accuracy(log, "v3_1", "pug").first().accuracy == 3.12
    assert metrics.class_accuracy(log, "v3_1", "wolf").first().accuracy == 0.0


def test_ties_in_the_top_list_go_by_name(spark):
    log = log_of(spark, [True], actual="b").union(log_of(spark, [True], actual="a"))
    assert [r.breed for r in metrics.top_classes_by_accuracy(log, "v3_1", 1).collect()] == ["a"]


STATS = "model_version string, class_label string, label_id int, example_count long, run_timestamp timestamp"


def stats_of(spark, rows):
    return spark.createDataFrame(
        [(v, c, 0, n, None) for v, c, n, _ in rows], STATS
    ).drop("run_timestamp").join(
        spark.createDataFrame([(v, c, n, t) for v, c, n, t in rows], "model_version string, class_label string, example_count long, t string"),
        ["model_version", "class_label", "example_count"],
    ).withColumn("run_timestamp", F.col("t").cast("timestamp")).drop("t")


def test_latest_is_per_class_not_per_run(spark):
    stats = stats_of(spark, [("v1", "a", 1, "2024-01-01"), ("v1", "b", 2, "2024-01-01"), ("v1", "a", 5, "2024-02-01")])
    got = {r.class_label: r.example_count for r in metrics.latest_distribution(stats).collect()}
    assert got == {"a": 5, "b": 2}
    top = metrics.top_classes_by_count(stats, "v1", 1).collect()
    assert [tuple(r) for r in top] == [("v1", "a", 5)]


def test_drift(spark):
    stats = stats_of(spark, [("v1", "a", 9, "2024-01-01"), ("v1", "b", 4, "2024-01-01"), ("v2", "a", 3, "2024-01-01"), ("v2", "c", 2, "2024-01-01")])
    p = np.array([10, 5, 1]) / 16
    q = np.array([4, 1, 3]) / 8
    got = metrics.drift(stats, "v1", "v2").first().kl
    assert got == pytest.approx(float(np.sum(p * np.log(p / q))))
    assert metrics.drift(stats, "v1", "v1").first().kl == pytest.approx(0.0)


def test_packed_matrix_round_trip(spark):
    rows = [("v1", "a", "b", 3), ("v1", "a", "a", 5), ("v2", "x", "x", 1)]
    matrix = spark.createDataFrame(rows, "model_version string, actual string, predicted string, n long")
    packed = confusion.pack(matrix, ["model_version"])
    assert {r.model_version: r.confusion_matrix for r in packed.collect()}["v1"] == "a:a:5|a:b:3"
    assert sorted(tuple(r) for r in confusion.unpack(packed, ["model_version"]).collect()) == sorted(rows)


def test_broken_entries_are_strict_or_lenient(spark):
    packed = spark.createDataFrame([("v1", "a:b|a:a:x")], "model_version string, confusion_matrix string")
    with pytest.raises(Exception):
        confusion.unpack(packed, ["model_version"]).collect()
    got = confusion.unpack(packed, ["model_version"], lenient=True).collect()
    assert [tuple(r) for r in got] == [("v1", "a", "b", None), ("v1", "a", "a", None)]


def expected_percentile(values, p):
    return float(np.percentile(np.array(values), p * 100))


def test_percentiles_with_a_hot_group(spark):
    """Groups of every size class, one with a single value."""
    rng = np.random.default_rng(1)
    groups = {
        "hot": np.round(rng.lognormal(0, 2, 60_000), 4),
        "flat": np.full(25_000, 2.5),
        "middle": rng.random(5_000),
        "few": rng.random(260),
        "whole": rng.random(249),
    }
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("hot", None)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(6)
    points = {"p5": 0.05, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    for held in (0, 300, quantiles.HELD):
        got = {r.g: r for r in quantiles.exact_percentiles(df, ["g"], "x", points, held=held).collect()}
        for g, values in groups.items():
            for name, p in points.items():
                assert got[g][name] == pytest.approx(expected_percentile(values, p), abs=1e-9), (g, name, held)


def test_percentiles_of_tiny_groups(spark):
    rows = [("a", 1.0), ("b", 1.0), ("b", 2.0), ("c", 3.0), ("c", 1.0), ("c", 2.0), ("d", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    for held in (0, quantiles.HELD):
        got = quantiles.exact_percentiles(df, ["g"], "x", {"p": 0.95}, held=held).collect()
        assert {r.g: round(r.p, 9) for r in got} == {"a": 1.0, "b": 1.95, "c": 2.9}


def test_a_hot_group_is_sorted_by_ranges(spark, monkeypatch):
    # a third of the rows in one hour, heavily tied and with far outliers
    df = spark.range(90_000).selectExpr(
        "if(id % 3 = 0, 'hot', concat('g', id % 50)) as g",
        "case when id % 1000 = 3 then 1e9 when id % 7 = 0 then 5.0 else pmod(hash(id), 10000) / 100 end as x",
    )
    staged = []
    keep = quantiles.stage
    monkeypatch.setattr(quantiles, "stage", lambda rows, name: staged.append((name, out := keep(rows, name))) or out)
    got = {r.g: (r.p50, r.p95) for r in quantiles.exact_percentiles(df, ["g"], "x", {"p50": 0.5, "p95": 0.95}, held=5_000).collect()}
    rows = df.groupBy("g").agg(F.expr("percentile(x, 0.5)"), F.expr("percentile(x, 0.95)")).collect()
    for r in rows:
        assert got[r[0]] == pytest.approx((r[1], r[2]), abs=1e-9), r[0]
    cells = dict(staged)["percentile-cells"]
    assert {r.g for r in cells.collect()} == {"hot"} and cells.count() <= 4


def test_chunks_of_a_large_matrix(spark):
    df = spark.range(40_000).selectExpr("'v' as model_version", "concat('c', id % 2000) as actual", "concat('c', hash(id) % 5) as predicted")
    matrix = confusion.build(df, ["model_version"])
    packed = confusion.pack_chunks(matrix, ["model_version"], 500)
    sizes = [len(r.confusion_matrix.split("|")) for r in packed.collect()]
    assert len(sizes) > 10 and max(sizes) <= 500 + 9
    back = confusion.unpack(packed, ["model_version"]).toDF("model_version", "actual", "predicted", "n")
    assert back.exceptAll(matrix).isEmpty() and matrix.exceptAll(back).isEmpty()


def test_hourly_keeps_groups_without_latency(spark):
    df = spark.sql(
        "select timestamp_ntz'2024-01-01 00:10:00' ts, 'v1' model_version, true is_correct, cast(null as double) latency"
    )
    row = metrics.hourly(df).first()
    assert (row.n, row.accuracy, row.p50_latency) == (1, 1.0, None)


def test_hourly_keeps_a_missing_version(spark):
    df = spark.sql(
        "select timestamp_ntz'2024-01-01 00:10:00' ts, cast(null as string) model_version, true is_correct, "
        "cast(id as double) latency from range(3)"
    )
    row = metrics.hourly(df).first()
    assert (row.model_version, row.n, row.p50_latency) == (None, 3, 1.0)


def test_volume_gate(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "version string")
    assert {r.version: r.retrain for r in metrics.volume_gate(df, 2).collect()} == {"a": True, "b": False}


def test_describe(spark):
    df = spark.sql("select 1 a, cast(null as string) b, current_timestamp() c, 1.5D d, true e")
    got = [tuple(r) for r in metrics.describe(df, descriptions={"a": "key"}).collect()]
    assert got == [
        ("a", "INTEGER", "REQUIRED", "key"), ("b", "STRING", "NULLABLE", ""),
        ("c", "TIMESTAMP", "REQUIRED", ""), ("d", "FLOAT", "REQUIRED", ""), ("e", "BOOLEAN", "REQUIRED", ""),
    ]


def test_modes_are_declared_not_measured(spark):
    declared = T.StructType([T.StructField("a", T.LongType(), True), T.StructField("b", T.LongType(), False, {"comment": "n"})])
    rows = spark.createDataFrame([(1, 2)], declared)
    assert [tuple(r) for r in metrics.describe(rows).collect()] == [("a", "INTEGER", "NULLABLE", ""), ("b", "INTEGER", "REQUIRED", "n")]
    empty = spark.createDataFrame([], "a long, b long")
    assert [r.mode for r in metrics.describe(empty, declared).collect()] == ["NULLABLE", "REQUIRED"]


def test_percentiles_of_small_large_and_hot_groups(spark):
    rows = spark.sql(
        "select case when id % 3 = 0 then 'hot' when id < 9 then concat('one', id) else concat('g', id % 40) end as k, "
        "cast(pmod(xxhash64(id), 5000) as double) as v from range(90000)"
    )
    got = {r.k: (r.p50, r.p95) for r in quantiles.exact_percentiles(rows, ["k"], "v", {"p50": 0.5, "p95": 0.95}, held=3000).collect()}
    exact = rows.groupBy("k").agg(F.percentile("v", F.lit(0.5)).alias("a"), F.percentile("v", F.lit(0.95)).alias("b"))
    for r in exact.collect():
        assert got[r.k] == pytest.approx((r.a, r.b), abs=1e-9)


def weights_of(spark, mapping, labels):
    label_map = spark.createDataFrame(list(mapping.items()), "class_name string, label_id int")
    counts = spark.createDataFrame([(i,) for i in labels], "label_id int").groupBy("label_id").agg(F.count("*").alias("n"))
    return {r.label_id: r.weight for r in training.class_weights(counts, label_map).collect()}


def test_class_weights(spark):
    got = weights_of(spark, {"a": 0, "b": 1, "c": 2}, [0, 0, 0, 1])
    assert got == {0: pytest.approx(1 / 3), 1: 1.0, 2: 1.0}


def test_class_weights_without_examples_are_null(spark):
    assert weights_of(spark, {"a": 0}, []) == {0: None}


def test_an_empty_vocabulary_is_an_error(spark):
    empty = spark.createDataFrame([], "class_name string, label_id int")
    with pytest.raises(ValueError):
        training.require_vocabulary(empty)


def test_split_sizes(spark):
    size = spark.createDataFrame([(1000,)], "dataset_size long")
    assert tuple(training.split_sizes(size, 0.3, 32).first()) == (1000, 300, 700, 21, 9)


def test_histogram_names_and_shares(spark):
    counts = spark.createDataFrame([(1, 3), (0, 1)], "label_id int, n long")
    label_map = spark.createDataFrame([("a", 0)], "class_name string, label_id int")
    got = [tuple(r) for r in validation.label_histogram(counts, label_map).collect()]
    assert got == [(0, "a", 1, 25.0), (1, "Unknown ID: 1", 3, 75.0)]


def test_file_reports(spark):
    files = spark.createDataFrame([(f,) for f in "aabbbc"], "filename string")
    assert tuple(validation.file_stats(files).first()) == (3, 6, 2)
    assert [tuple(r) for r in validation.duplicate_files(files).collect()] == [("b", 3), ("a", 2)]
    assert tuple(validation.file_stats(files.limit(0)).first()) == (0, 0, 0)


def test_any_model_plugs_in(spark):
    def load():
        return lambda batch: batch["x"].map(lambda x: [1 - x, x])

    rows = spark.createDataFrame([(1, 0.25), (2, 0.75)], "id int, x double")
    scored = scoring.predict(scoring.score_with(rows, load, ["id", "x"]))
    label_map = spark.createDataFrame([("no", 0), ("yes", 1)], "class_name string, label_id int")
    got = scoring.decode(scored, label_map).orderBy("id").collect()
    assert [(r.predicted, r.confidence) for r in got] == [("no", 0.75), ("yes", 0.75)]


def test_evaluation(spark):
    rows = [([0.7, 0.2, 0.1], 0), ([0.7, 0.2, 0.1], 1)]
    df = spark.createDataFrame(rows, "scores array<double>, label int")
    got = scoring.evaluate(df, 2).first()
    assert (got.accuracy, got.top_k_accuracy) == (0.5, 1.0)
    assert got.cross_entropy == pytest.approx(-(math.log(0.7) + math.log(0.2)) / 2)


def test_nearest_centroid_ties_go_to_the_lowest_label(spark):
    rows = [(1, [0.0, 1.0], 3), (2, [0.0, -1.0], 2), (3, [0.0, 0.0], 2), (4, [0.0, 0.25], 3)]
    df = spark.createDataFrame(rows, "id int, embedding array<float>, label int")
    centers = spark.createDataFrame([(3, [0.0, 1.0]), (2, [0.0, -1.0])], "label int, centroid array<double>")
    got = scoring.nearest_centroid(df, centers).collect()
    assert {r.id: r.predicted_id for r in got} == {1: 3, 2: 2, 3: 2, 4: 3}
    means = {r.label: r.centroid for r in scoring.centroids(df).collect()}
    assert means == {3: [0.0, 0.625], 2: [0.0, -0.5]}


def test_rows_without_a_label_are_no_class(spark):
    rows = spark.createDataFrame([(1, [1.0], None), (2, [3.0], 4), (3, None, None)], "id int, embedding array<double>, label int")
    centers = scoring.centroids(rows)
    assert [r.label for r in centers.collect()] == [4]
    nulls = spark.createDataFrame([(None, [9.0])], "label int, centroid array<double>")
    got = scoring.nearest_centroid(rows, centers.unionByName(nulls)).collect()
    assert {r.id: r.predicted_id for r in got} == {1: 4, 2: 4, 3: None}
    assert {r.predicted_id for r in scoring.nearest_centroid(rows, nulls).collect()} == {None}


def test_many_labels_and_dimensions(spark):
    centers = spark.range(20_000).selectExpr("cast(id as int) as label", "transform(sequence(1, 512), i -> cast(pmod(hash(id, i), 100) as double)) as centroid")
    rows = centers.where("label % 4000 = 7").selectExpr("label as id", "centroid as embedding")
    got = {r.id: r.predicted_id for r in scoring.nearest_centroid(rows, centers, limit=32 << 20).collect()}
    assert got == {i: i for i in range(7, 20_000, 4000)}


def test_centroids_beyond_one_block(spark):
    import random

    rng = random.Random(4)
    vector = lambda: [float(rng.randint(-3, 3)) for _ in range(4)]
    points = [(i, vector() if i % 9 else None) for i in range(60)]
    known = [(label, vector()) for label in range(25)]
    rows = spark.createDataFrame(points, "vec_id long, embedding array<double>")
    centers = spark.createDataFrame(known[::-1], "label int, centroid array<double>")
    distance = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    wanted = {i: v and min(known, key=lambda c: (distance(v, c[1]), c[0]))[0] for i, v in points}
    for limit in (1, 8 * 4 * 10, 1 << 20):
        out = scoring.nearest_centroid(rows, centers, limit=limit)
        assert out.columns == ["vec_id", "embedding", "predicted_id"]
        assert {r["vec_id"]: r["predicted_id"] for r in out.collect()} == wanted
