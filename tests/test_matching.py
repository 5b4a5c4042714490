"""Label comparison: the ladder, the aliases and the similarity ratio."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from perennial.functions import matching


def subsequence(a: str, b: str) -> int:
    row = [0] * (len(b) + 1)
    for ch in a:
        last = row
        row = [0]
        for j, other in enumerate(b):
            row.append(last[j] + 1 if ch == other else max(last[j + 1], row[j]))
    return row[-1]


def ratio(a: str, b: str) -> int:
    return 100 if a == b else round(200 * subsequence(a, b) / (len(a) + len(b)))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(st.text(alphabet="abc d", max_size=9), st.text(alphabet="abcé d", max_size=9)),
        min_size=1,
        max_size=40,
    )
)
def test_ratio_matches_the_plain_algorithm(spark, pairs):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    got = df.orderBy("i").select(matching.fuzzy_ratio(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in got] == [ratio(a, b) for a, b in pairs]


def test_ratio_of_long_texts(spark):
    a = "the quick brown fox jumps over the lazy dog " * 5
    b = a.replace("quick", "slow").replace("dog", "cat")
    df = spark.createDataFrame([(a, b)], "a string, b string")
    assert df.select(matching.fuzzy_ratio(F.col("a"), F.col("b"))).first()[0] == ratio(a, b)


def test_ratio_edges(spark):
    df = spark.createDataFrame(
        [(0, None, "a"), (1, "", ""), (2, "", "abc"), (3, "abc", "")], "i int, a string, b string"
    )
    got = df.orderBy("i").select(matching.fuzzy_ratio(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in got] == [0, 100, 0, 0]


CASES = [
    # actual, predicted, base rule, fine-tuned rule
    ("hound blood", "bloodhound", True, False),
    ("terrier scottish", "Scotch_terrier", False, False),
    ("hound afghan", "Afghan_hound", True, False),
    ("husky", "Siberian_husky", True, False),
    ("", "_", True, False),
    ("", "akita", False, False),
    ("Akita", "akita", True, False),
    ("akita", "akita", True, True),
    ("pembroke", "pembrok", True, False),
    ("pug", "beagle", False, False),
    ("a b c d", "a b c e", True, False),
    ("a b c", "a b e", False, False),
    ("akita", None, None, False),
    (None, None, None, True),
]


@pytest.fixture(scope="module")
def judged(spark):
    rows = [(i, a, p) for i, (a, p, _, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "i int, actual string, predicted string")
    return {r.i: r for r in matching.with_matches(df).collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_ladder(judged, i):
    assert (judged[i].base_match, judged[i].tuned_match) == CASES[i][2:]


def test_three_quarters_of_the_words_match(judged):
    # three of four words agree on both sides
    assert judged[10].base_match


def test_repeated_pairs_keep_every_row(spark):
    df = spark.range(1000).select(
        F.lit("husky").alias("actual"), F.lit("Siberian_husky").alias("predicted")
    )
    got = matching.with_matches(df)
    assert got.count() == 1000
    assert got.filter("base_match").count() == 1000


def test_rule_depends_on_the_version(spark):
    df = spark.createDataFrame(
        [("v3_0", "Akita", "akita"), ("v3_1", "Akita", "akita")],
        "model_version string, actual string, predicted string",
    )
    got = matching.with_matches(df).withColumn("ok", matching.is_match(F.col("model_version")))
    assert {r.model_version: r.ok for r in got.collect()} == {"v3_0": True, "v3_1": False}


def test_alias_modes(spark):
    df = spark.createDataFrame([("terrier scottish", "Scotch_terrier")], "a string, p string")
    row = df.select(
        matching.base_match(F.col("a"), F.col("p")),
        matching.base_match(F.col("a"), F.col("p"), "normalized"),
        matching.words(F.lit("Saint_Bernard")),
        matching.words(F.lit("Saint_Bernard"), "normalized"),
    ).first()
    assert tuple(row) == (False, True, ["bernard", "saint"], ["stbernard"])
    with pytest.raises(ValueError):
        matching.words(F.lit("x"), "other")


def test_words(spark):
    row = spark.range(1).select(matching.words(F.lit(" \tHound-Afghan__hound\n "))).first()
    assert row[0] == ["afghan", "hound"]


@pytest.mark.parametrize("n, m", [(0, 5), (61, 61), (62, 122), (123, 60), (500, 480)])
def test_common_subsequence_across_words_of_bits(spark, n, m):
    rng = random.Random(n + m)
    a, b = ("".join(rng.choice("abcé ") for _ in range(k)) for k in (n, m))
    row = [0] * (len(b) + 1)
    for x in a:
        before = row[:]
        for j, y in enumerate(b):
            row[j + 1] = before[j] + 1 if x == y else max(row[j], before[j + 1])
    df = spark.createDataFrame([(a, b)], "a string, b string")
    assert df.select(matching.common_subsequence(F.col("a"), F.col("b"))).first()[0] == row[-1]
