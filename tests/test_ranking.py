"""Exact shares and positions against a plain sort."""

import hashlib
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from perennial.operators import ranking, training


def in_order(keys, seed=42):
    return sorted(keys, key=lambda k: (hashlib.md5(f"{seed}|{k}".encode()).hexdigest(), k))


@pytest.mark.parametrize("n", [0, 1, 4, 5, 14, 1000])
@pytest.mark.parametrize("fraction", [0.0, 0.2, 0.3])
def test_share_is_the_head_of_the_order(spark, n, fraction):
    keys = [f"v/{i}.jpg" for i in range(n)]
    df = spark.createDataFrame([(k,) for k in keys], "path string")
    marked = ranking.mark_share(df, "path", fraction).collect()
    assert sorted(r.path for r in marked) == sorted(keys)
    head = set(in_order(keys)[: int(n * fraction)])
    assert {r.path for r in marked if r.taken} == head


def test_share_per_group_with_one_hot_group(spark):
    # group 0 holds most rows
    df = spark.range(20_000).select(
        F.when(F.col("id") % 10 < 7, F.lit("hot")).otherwise((F.col("id") % 10).cast("string")).alias("g"),
        F.concat(F.lit("p"), F.col("id").cast("string")).alias("path"),
    )
    rows = df.collect()
    marked = ranking.mark_share(df, "path", 0.2, by=["g"]).filter("taken").collect()
    for g in {r.g for r in rows}:
        keys = [r.path for r in rows if r.g == g]
        assert {r.path for r in marked if r.g == g} == set(in_order(keys)[: int(len(keys) * 0.2)])


def test_copies_of_one_key_are_counted_one_by_one(spark):
    df = spark.createDataFrame([("same",)] * 50 + [(str(i),) for i in range(50)], "path string")
    assert ranking.mark_share(df, "path", 0.3).filter("taken").count() == 30
    positions = sorted(r.position for r in ranking.with_position(df, "path").collect())
    assert positions == list(range(1, 101))


@pytest.mark.parametrize("seed", [42, 7])
def test_positions(spark, seed):
    keys = [f"k{i}" for i in range(3000)]
    df = spark.createDataFrame([(k,) for k in keys], "path string").repartition(5)
    got = {r.path: r.position for r in ranking.with_position(df, "path", seed).collect()}
    assert got == {k: i + 1 for i, k in enumerate(in_order(keys, seed))}


def test_order_does_not_depend_on_partitioning(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("path"))
    one = ranking.mark_share(df.coalesce(1), "path", 0.3).filter("taken").collect()
    many = ranking.mark_share(df.repartition(17), "path", 0.3).filter("taken").collect()
    assert {r.path for r in one} == {r.path for r in many}


def test_fraction_is_checked(spark):
    with pytest.raises(ValueError):
        ranking.mark_share(spark.range(1), "id", 1.0)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.integers(0, 400), st.sampled_from([0.1, 0.2, 0.3, 0.7]))
def test_split_is_disjoint_total_and_exact(spark, n, fraction):
    df = spark.range(n).select(F.col("id").cast("string").alias("path"))
    parts = training.split(df, "path", fraction).collect()
    assert sorted(int(r.path) for r in parts) == list(range(n))
    assert sum(r.part == "val" for r in parts) == math.floor(n * fraction)


def test_batches_keep_the_remainder(spark):
    df = spark.range(70).select(F.col("id").cast("string").alias("path"))
    sizes = training.batched(training.shuffled(df, "path"), 32).groupBy("batch_id").count()
    assert sorted(tuple(r) for r in sizes.collect()) == [(0, 32), (1, 32), (2, 6)]


def test_null_keys_are_ranked_too(spark):
    df = spark.createDataFrame([(None,), ("",), ("a",), (None,), ("b",)], "k string")
    assert sorted(r.position for r in ranking.with_position(df, "k").collect()) == [1, 2, 3, 4, 5]
    assert sum(r.taken for r in ranking.mark_share(df, "k", 0.6).collect()) == 3
