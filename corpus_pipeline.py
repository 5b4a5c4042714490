"""From raw documents to packed sequences in five stages."""

from __future__ import annotations

import os
import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import perennial  # noqa: E402
from perennial.llm import decontaminate, lines, minhash, packing, quality  # noqa: E402
from perennial.session import stage  # noqa: E402

# Python workers get the functions themselves, so the package need not be installed there.
cloudpickle.register_pickle_by_value(perennial)

POLICY = "v2"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality policy."""
    judged = quality.apply_policy(quality.ledger(docs), POLICY)
    return judged.where("kept").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the boilerplate lines of their source; ``n_chars`` follows the text."""
    cleaned = lines.drop_boilerplate(docs).withColumn("n_chars", F.char_length("text").cast("long"))
    return cleaned.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the smallest id."""
    return minhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no ten-word window of the benchmark."""
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences of 2,048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("best-fit packing", best_fit_packing),
]

# Components, token ids and packing are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each stage's result written and read again."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        rows = stage(function(spark, rows, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, rows, sf_dir)
