"""Columns of the input that bear an operator's own names, in any case."""

import pytest
from pyspark.sql import functions as F

from perennial.llm import (
    decontaminate,
    extraction,
    interactions,
    lexical,
    lines,
    matrices,
    minhash,
    names,
    packing,
    quality,
    repeats,
    sharding,
)

INTERNAL = "_drop _key _keys _kept _site _dropped key blob spans _words _lines _hashes c0_ c1_ SPANS row hash n terms place local".split()
MADE = ["N_Words", "Items", "n_LINES", "Shard", "Slot", "n_chars"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, f"some plain words of text number {i} " * 3 + "\nfooter", "s") for i in range(6)] + [(7, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    # names that differ in case only would be one column to Spark, so each is there once
    return df.select("*", *[F.lit(c).alias(c) for c in INTERNAL if c != "SPANS"], *[F.lit(c).alias(c) for c in MADE])


def test_helpers(spark):
    df = spark.createDataFrame([(1, 2, 3)], "Key long, c0_ long, other long")
    renamed, back = names.aside(df, ["key"])
    assert renamed.columns[1:] == ["c0_", "other"] and set(back.values()) == {"Key"}
    assert renamed.withColumnsRenamed(back).columns == df.columns
    assert names.without(df, ["KEY", "none"]).columns == ["c0_", "other"]


BENCHMARK = [("i", "nothing that is there at all in any of these few texts")]
OPERATORS = {
    "repeats": (lambda d, b: repeats.remove_repeats(d), {"text"}, {"n_bytes", "n_removed", "n_spans", "kept"}),
    "decontaminate.find": (lambda d, b: decontaminate.find(d, b), set(), set(decontaminate.MADE)),
    "decontaminate.remove": (lambda d, b: decontaminate.remove_contaminated(d, b), set(), None),
    "lines": (lambda d, b: lines.drop_boilerplate(d, ratio=0.5), set(), {"n_lines", "n_dropped"}),
    "quality": (lambda d, b: quality.apply_policy(quality.ledger(d)), set(), {"base_failed", "kept", "fail_bits", "n_words", "word_chars", "n_lines", "n_symbols", "n_exclaims", "n_digits", "n_dup_lines", "n_repeat_words"}),
    "minhash": (lambda d, b: minhash.keep_one(d), set(), None),
    "sharding": (lambda d, b: sharding.shuffle(d, ["doc_id"], 3), set(), {"shard", "slot"}),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_own_columns_stay_or_are_replaced(spark, docs, name):
    operator, gone, made = OPERATORS[name]
    benchmark = spark.createDataFrame(BENCHMARK, "item_id string, text string")
    out = operator(docs, benchmark)
    rows = out.collect()
    columns = [c.lower() for c in out.columns]
    assert len(columns) == len(set(columns))
    replaced = {c for c in docs.columns if c.lower() in (made or ())}
    for column in set(docs.columns) - replaced - gone:
        assert column in out.columns
        if column in INTERNAL + MADE:
            assert {r[column] for r in rows} == {column}
    assert made is None or made <= set(out.columns)


def test_operators_with_columns_of_their_own(spark, docs):
    benchmark = spark.createDataFrame(BENCHMARK, "item_id string, text string").withColumn("item", F.lit(1))
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert interactions.audit(docs, labels, part="source").count() == 2 * 600
    assert lexical.rank(docs, benchmark).count() >= 0
    assert packing.pack(docs).count() == 7 and matrices.pack(docs).count() >= 1
    pages = docs.select("doc_id", F.lit("<p>Text of a page, with words.</p>").alias("html"), F.lit(1).alias("TEXT"), F.lit(2).alias("N_chars"))
    out = extraction.extract(pages)
    assert [c.lower() for c in out.columns] == ["doc_id", "html", "text", "n_chars"]
