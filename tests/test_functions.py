"""Versions, paths, text and vector functions on small inputs."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from perennial.functions import paths, text, vectors, versions


def column(spark, values, expression, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


def test_version_numbers(spark):
    names = ["v3_10", "v3_2_bak", "v30_1", "bad", "v3", None]
    assert column(spark, names, versions.major) == [3, 3, 30, None, None, None]
    assert column(spark, names, versions.minor) == [10, 2, 1, None, None, None]


def test_job_version():
    assert versions.job_version("v3_10") == ("v3", 10)
    for broken in ("v3", "v3_1_2", "v3_x"):
        with pytest.raises(ValueError):
            versions.job_version(broken)


def test_earlier_is_numeric_and_within_the_major(spark):
    names = ["v3_2", "v3_9", "v3_10", "v3_11", "v30_1", "v3_x", "v3_2_bak", None]
    earlier = column(spark, names, lambda c: versions.is_earlier(c, "v3_10"))
    assert earlier == [True, True, False, False, False, False, True, False]


def test_next_version(spark):
    names = ["v3_9", "v3_10", "3_1", "v3", "v3_x", "v3_1_2", None]
    assert column(spark, names, versions.next_version) == [
        "v3_10", "v3_11", "v3_2", None, None, None, None,
    ]


def test_training_mode(spark):
    names = [None, "None", "v3_0", "v3_1", "v4_0", "junk"]
    assert column(spark, names, versions.training_mode) == [
        "new", "new", "new", "warm_start", "warm_start", "new",
    ]


def test_parameter_patterns(spark):
    assert column(spark, ["v-20240312", "v3_1", "v 3", "", None], versions.is_valid_id) == [
        True, True, False, False, False,
    ]
    assert column(spark, ["42", "4x", "", None], versions.is_whole_number) == [
        True, False, False, False,
    ]


def test_label_path_replaces_every_suffix(spark):
    assert column(spark, ["a.jpg.b.jpg"], paths.label_path) == ["a_labels.json.b_labels.json"]


def test_names_in_paths(spark):
    path = "v3_2/x/hound afghan_17.tar.jpg"
    assert column(spark, [path], paths.file_stem) == ["hound afghan_17"]
    label_file = "incorrect_predictions/german shepherd_12345_labels.json"
    assert column(spark, [label_file], paths.label_in_name) == ["german shepherd"]
    assert column(spark, [path], paths.version_of) == ["v3_2"]
    assert column(spark, [path], paths.outcome_of) == ["x"]


def test_suffixes(spark):
    names = ["a.jpg", "a.JPG", "a_labels.json", "a.JSON"]
    assert column(spark, names, paths.is_image) == [True, False, False, False]
    assert column(spark, names, paths.is_label_file) == [False, False, True, False]
    assert column(spark, names, paths.is_json) == [False, False, True, True]


def test_label_in_url(spark):
    url = "https://images.example.org/breeds/hound-afghan/n02088094_1003.jpg"
    assert column(spark, [url], paths.label_in_url) == ["hound afghan"]


def test_stored_stem(spark):
    df = spark.sql(
        "select 'v3_1' v, c, 'husky' p, 'akita' a, timestamp'2024-01-01 00:00:01.9Z' t, 7 id "
        "from values (true), (false) as s(c)"
    )
    stem = paths.stored_stem(*[F.col(c) for c in ("v", "c", "p", "a", "t", "id")])
    assert [r[0] for r in df.orderBy(F.desc("c")).select(stem).collect()] == [
        "v3_1/correct_predictions/husky_1704067201_7",
        "v3_1/incorrect_predictions/akita_1704067201_7",
    ]


def test_as_utc_ignores_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        row = spark.sql("select timestamp_ntz'2024-07-01 00:00:00' as t").select(
            F.unix_seconds(paths.as_utc(F.col("t")))
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert row[0] == dt.datetime(2024, 7, 1, tzinfo=dt.UTC).timestamp()


def test_label_json(spark):
    docs = [
        '{"model_label": "affenpinscher", "api_label": "affenpinscher"}',
        '{"model_label": "x"}',
        "{bad",
        '{"api_label": "a"} trailing',
        "{'api_label': 'a'}",
        '{"api_label": "a"}, {"api_label": "b"}',
        "",
        "[1]",
        None,
    ]
    parsed = column(spark, docs, text.parse_label_json)
    assert [p.valid for p in parsed] == [True, True, False, False, False, False, False, True, False]
    assert [p.api_label for p in parsed] == ["affenpinscher"] + [None] * 8
    assert parsed[0].model_label == "affenpinscher"


def test_times_and_names(spark):
    row = spark.sql("select timestamp'2024-03-05 06:07:08.25Z' as t").select(
        text.run_name("training", F.col("t")),
        text.hour_folder(F.col("t")),
        text.rfc3339(F.col("t")),
        text.experiment_name(F.lit("v3_4")),
    ).first()
    assert tuple(row) == (
        "training-20240305-060708", "2024-03-05-06", "2024-03-05T06:07:08.250000Z", "v3-4",
    )


def test_percent_is_half_even(spark):
    assert column(spark, [1 / 32, 1 / 3, None], text.percent, "double") == [3.12, 33.33, 0.0]


def test_score_functions(spark):
    rows = [([0.2, 0.5, 0.5], 1), ([0.2, 0.5, 0.5], 2), ([1.0, 0.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "s array<double>, y int")
    s, y = F.col("s"), F.col("y")
    got = df.select(
        vectors.best_index(s),
        vectors.best_score(s),
        vectors.is_top_1(s, y),
        vectors.is_top_k(s, y, 1),
        vectors.cross_entropy(s, y),
    ).collect()
    assert [tuple(r)[:4] for r in got] == [
        (1, 0.5, True, True), (1, 0.5, False, True), (0, 1.0, False, False),
    ]
    assert got[0][4] == pytest.approx(-math.log(0.5))
    assert got[2][4] == pytest.approx(-math.log(1e-7))


def test_pixels_land_in_unit_range(spark):
    [px] = column(spark, [[0.0, 127.5, 255.0]], vectors.to_unit_range, "array<double>")
    assert px == [-1.0, 0.0, 1.0]
