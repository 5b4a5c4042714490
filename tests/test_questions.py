"""The standing questions by table name."""

import pytest

from perennial.plans import questions, views


@pytest.fixture(scope="module", autouse=True)
def warehouse(spark, sf_dir):
    views.prediction_metrics(spark, sf_dir).createOrReplaceTempView("prediction_metrics")
    views.class_distribution(spark, sf_dir).createOrReplaceTempView("class_distribution")
    views.model_metrics(spark, sf_dir).withColumnRenamed("ts", "timestamp").createOrReplaceTempView(
        "model_metrics"
    )


def test_schema(spark):
    got = {r.name: (r.type, r.mode) for r in questions.table_schema(spark, "prediction_metrics").collect()}
    assert got["is_correct"] == ("BOOLEAN", "NULLABLE")
    assert got["latency"] == ("FLOAT", "NULLABLE")


def test_top_lists_are_sorted_and_limited(spark):
    counts = [r.example_count for r in questions.top_classes_by_example_count(spark, "class_distribution", "v3_3", 3).collect()]
    assert len(counts) == 3 and counts == sorted(counts, reverse=True)
    shares = [r.accuracy for r in questions.top_breeds_by_accuracy(spark, "prediction_metrics", "v3_3", 2).collect()]
    assert len(shares) == 2 and shares == sorted(shares, reverse=True)


def test_values_are_bound_not_spliced(spark):
    odd = "v3_3' or '1'='1"
    assert questions.breed_accuracy(spark, "prediction_metrics", odd, "click").first().accuracy == 0.0
    assert questions.top_breeds_by_accuracy(spark, "prediction_metrics", odd).count() == 0


def test_winner(spark):
    row = questions.winner(spark, "prediction_metrics", "v3_11", "v3_0").first()
    assert row.winner == ("v3_0" if row.challenger_score > row.champion_score else "v3_11")


def test_time_range_includes_both_ends(spark):
    days = questions.confusion_between(spark, "model_metrics", "2024-01-05", "2024-01-06")
    assert {str(r[0])[:10] for r in days.select("timestamp").distinct().collect()} == {"2024-01-05", "2024-01-06"}
