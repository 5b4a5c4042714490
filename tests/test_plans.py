"""The shape of the physical plans, and the rules the code keeps at scale."""

import pathlib
import re

import pytest

from perennial.plans import catalog, views
from perennial.session import shared_folder, stage

PACKAGE = pathlib.Path(catalog.__file__).resolve().parents[1]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


BATCH = sorted(k for k in catalog.queries() if not k.startswith(("stream_", "write_")))


@pytest.mark.parametrize("key", BATCH)
def test_no_query_multiplies_rows(spark, sf_dir, key):
    text = plan(catalog.queries()[key](spark, sf_dir))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_only_needed_columns_are_read(spark, sf_dir):
    text = plan(catalog.queries()["top_breeds"](spark, sf_dir))
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string>" in text
    text = plan(catalog.queries()["replay_sample"](spark, sf_dir))
    assert "text" not in re.findall(r"ReadSchema: struct<([^>]*)>", text)[0]


def test_stored_pairs_meet_in_their_buckets(spark, sf_dir):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        text = plan(catalog.queries()["pair_stored"](spark, sf_dir))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "SortMergeJoin" in text and "Exchange" not in text


def test_top_lists_are_not_sorted_globally(spark, sf_dir):
    for key in ("top_breeds", "top_classes", "list_json_capped"):
        assert "TakeOrderedAndProject" in plan(catalog.queries()[key](spark, sf_dir))


def test_newest_row_is_picked_before_the_shuffle(spark, sf_dir):
    stored = stage(views.class_distribution(spark, sf_dir), "cd")
    from perennial.operators import metrics

    text = plan(metrics.latest_distribution(stored))
    assert "WindowGroupLimit" in text.split("Exchange", 1)[1]


def test_version_filter_reaches_the_stored_table(spark, sf_dir):
    stored = stage(views.class_distribution(spark, sf_dir), "cd")
    from perennial.operators import metrics

    assert "EqualTo(model_version,v3_3)" in plan(metrics.top_classes_by_count(stored, "v3_3", 3))


def test_staged_lookup_is_broadcast_by_its_size_only(spark, sf_dir):
    text = plan(catalog.queries()["training_examples"](spark, sf_dir))
    assert re.search(r"BroadcastHashJoin \[\w*api_label#", text)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
        text = plan(catalog.queries()["training_examples"](spark, sf_dir))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "BroadcastHashJoin" not in text


def test_share_cut_shuffles_counts_and_one_range_only(spark, sf_dir):
    text = plan(catalog.queries()["replay_sample"](spark, sf_dir))
    assert text.count("Exchange hashpartitioning") == 1


def test_stages_are_written_below_the_shared_folder(spark):
    staged = stage(spark.range(3), "t")
    assert all(shared_folder(spark) in f for f in staged.inputFiles())


def test_no_forbidden_calls_in_the_package():
    banned = re.compile(r"localCheckpoint|crossJoin|\.toPandas\(|\.rdd\b|applyInPandas\(|F\.udf|\.sample\(")
    for source in PACKAGE.rglob("*.py"):
        if source.parent.name == "llm":
            continue
        assert not banned.search(source.read_text()), source
