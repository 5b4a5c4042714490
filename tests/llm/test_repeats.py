import random

import pytest
from pyspark.sql import functions as F

from perennial.llm import repeats, suffixes
from tests.llm import brute


def found(df, **options):
    rows = repeats.remove_repeats(df, **options).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)
    )
    return sorted((tuple(r) for r in rows.collect()), key=repr)


def texts(seed, n=80):
    rng = random.Random(seed)
    made = lambda k: "".join(rng.choice("abcdé \n") for _ in range(k))
    shared = [made(rng.randint(20, 400)) for _ in range(4)]
    rows = [
        (i, made(rng.randint(0, 200)) + rng.choice(shared) + made(rng.randint(0, 3)) + (rng.choice(shared) if i % 2 else ""))
        for i in range(n)
    ]
    odd = [None, "", "a" * 900, "ab" * 300, rows[3][1], rows[3][1], "x" * 199, "\x00" * 250]
    return rows + [(1000 + i, t) for i, t in enumerate(odd)]


@pytest.mark.parametrize("length, anchor, gathered", [(200, 32, 256), (60, 12, 2), (200, 32, 3)])
def test_removes_what_counting_every_string_removes(spark, length, anchor, gathered):
    rows = texts(length + gathered)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df, length=length, anchor=anchor, gathered=gathered) == brute.repeats(rows, length)


def test_given_documents(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in df.collect()]
    assert found(df) == brute.repeats(rows, 200)


def test_repeated_rows_null_ids_and_clashing_columns(spark):
    rows = [(1, "p" * 10 + "q" * 250, 5, "k"), (1, "p" * 10 + "q" * 250, 5, "k"), (None, "short", 6, "l")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_bytes int, key string")
    out = repeats.remove_repeats(df)
    assert out.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
    assert sorted((r["n_bytes"], r["n_removed"], r["n_spans"]) for r in out.collect()) == [(5, 0, 0), (260, 260, 1), (260, 260, 1)]


def test_empty_table(spark):
    assert found(spark.createDataFrame([], "doc_id long, text string")) == []


def test_text_longer_than_a_chunk(spark, monkeypatch):
    monkeypatch.setattr("perennial.llm.hashing.CHUNK", 1000)
    rng = random.Random(5)
    passage = "".join(rng.choice("abcdef") for _ in range(700))
    rest = "".join(rng.choice("abcdef") for _ in range(4000))
    rows = [(1, rest[:1700] + passage + rest[1700:]), (2, passage[100:600]), (3, rest[3000:3400])]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute.repeats(rows, 200)


def test_deep_shallow_order_sorts():
    rng = random.Random(2)
    for _ in range(300):
        base = bytes(rng.choice(b"ab") for _ in range(60))
        strings = [base[: rng.randint(0, 60)] + bytes(rng.choice(b"ab\x00\xff") for _ in range(rng.randint(0, 5))) for _ in range(rng.randint(0, 30))]
        order = suffixes.deep_shallow_order(strings, 0, rng.choice([0, 1, 4, 16]))
        assert sorted(order) == list(range(len(strings)))
        assert [strings[i] for i in order] == sorted(strings)
