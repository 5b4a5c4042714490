"""The champion and challenger state machine."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from perennial.operators import metrics, promotion
from perennial.plans import jobs
from perennial.sources import sinks, tables


def state_of(spark, champion, challenger):
    return spark.createDataFrame([(champion, challenger)], "champion string, challenger string")


def scores_of(spark, scores):
    return spark.createDataFrame(list(scores.items()), "model_version string, avg_prediction_accuracy double")


@pytest.mark.parametrize(
    "scores, winner",
    [
        ({"v3_2": 0.5, "v3_3": 0.6}, "v3_3"),
        ({"v3_2": 0.5, "v3_3": 0.5}, "v3_2"),
        ({"v3_2": 0.5}, "v3_2"),
        ({"v3_3": 0.1}, "v3_3"),
        ({}, "v3_2"),
        ({"v3_2": None, "v3_3": None}, "v3_2"),
    ],
)
def test_winner(spark, scores, winner):
    got = promotion.evaluate(state_of(spark, "v3_2", "v3_3"), scores_of(spark, scores)).first()
    assert got.winner == winner
    assert got.champion_score == (scores.get("v3_2") or 0.0)
    assert got.challenger_score == (scores.get("v3_3") or 0.0)


def test_version_without_any_verdict_scores_zero(spark):
    log = spark.createDataFrame(
        [("v3_2", None), ("v3_3", True)], "model_version string, is_correct boolean"
    )
    got = promotion.evaluate(state_of(spark, "v3_2", "v3_3"), metrics.accuracy_by_version(log)).first()
    assert (got.champion_score, got.challenger_score, got.winner) == (0.0, 1.0, "v3_3")


def test_one_version_in_both_roles(spark):
    got = promotion.evaluate(state_of(spark, "v3_0", "v3_0"), scores_of(spark, {"v3_0": 0.4})).first()
    assert (got.champion_score, got.challenger_score, got.winner) == (0.4, 0.4, "v3_0")


@pytest.mark.parametrize(
    "challenger_score, expected",
    [
        (0.6, ("v3_3", "v3_3", "v3_4", "champion-service", "v3_3")),
        (0.4, ("v3_2", "v3_2", "v3_4", "challenger-service", "v3_3")),
    ],
)
def test_step(spark, challenger_score, expected):
    scores = scores_of(spark, {"v3_2": 0.5, "v3_3": challenger_score})
    got = promotion.step(promotion.evaluate(state_of(spark, "v3_2", "v3_3"), scores)).first()
    assert tuple(got) == expected


def test_state_is_saved_and_the_newest_read(spark, tmp_path):
    folder = str(tmp_path / "state")
    (tmp_path / "state").mkdir()
    (tmp_path / "state" / "state-0.json").write_text(
        '{\n  "champion": {"model_version": "v3_9", "deployed_at": "2024-01-01T00:00:00Z"},\n'
        '  "challenger": {"model_version": "v3_10", "deployed_at": null}\n}'
    )
    log = spark.createDataFrame(
        [("v3_9", False), ("v3_10", True)], "model_version string, is_correct boolean"
    )
    decision = jobs.promote(spark, log, folder, "1", "2024-02-01T00:00:00Z").first()
    assert tuple(decision) == ("v3_10", "v3_10", "v3_11", "champion-service", "v3_10")
    state = tables.read_state(spark, folder).first()
    assert (state.champion.model_version, state.champion.deployed_at) == ("v3_10", "2024-02-01T00:00:00Z")
    assert (state.challenger.model_version, state.challenger.deployed_at) == ("v3_11", None)
    # nothing is known about v3_11, so the champion stays and keeps its time
    jobs.promote(spark, log, folder, "2", "2024-03-01T00:00:00Z")
    state = tables.read_state(spark, folder).first()
    assert (state.champion.model_version, state.champion.deployed_at) == ("v3_10", "2024-02-01T00:00:00Z")
    assert state.challenger.model_version == "v3_12"


def test_saved_states_are_never_overwritten(spark, tmp_path):
    state = spark.range(1).select(
        F.expr("named_struct('model_version', 'v3_1', 'deployed_at', cast(null as string))").alias("champion"),
        F.expr("named_struct('model_version', 'v3_2', 'deployed_at', cast(null as string))").alias("challenger"),
    )
    sinks.save_state(state, str(tmp_path), "1")
    with pytest.raises(Exception):
        sinks.save_state(state, str(tmp_path), "1")


def test_deployment_time_text():
    assert jobs.deployed_at(dt.datetime(2024, 1, 2, 3, 4, 5)) == "2024-01-02T03:04:05Z"
