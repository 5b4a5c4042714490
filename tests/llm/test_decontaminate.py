import random

from perennial.llm import decontaminate
from tests.llm import brute


def found(df, items, **options):
    rows = decontaminate.find(df, items, **options).select("doc_id", "n_words", "n_hit", "items")
    return sorted((tuple(r) for r in rows.collect()), key=repr)


def tables(spark, seed=1):
    rng = random.Random(seed)
    say = lambda n: " ".join(rng.choice("the a Of-of AND x1 é Éa in".split()) for _ in range(n))
    items = [(i, say(rng.choice((0, 1, 3, 9, 10, 11, 25)))) for i in range(30)] + [(30, None), (None, "null id item words"), (3, "x1 x1")]
    docs = [(i, say(rng.randint(0, 60)) + "\t" + (items[i % 30][1] or "").upper() + "!" + say(5)) for i in range(60)]
    docs += [(100, None), (101, ""), (101, ""), (None, "null id item words"), (102, "the " * 5000)]
    return docs, items, spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


def test_finds_every_window(spark):
    docs, items, df, benchmark = tables(spark)
    assert found(df, benchmark) == brute.leaks(docs, items)


def test_blocks_of_the_benchmark_give_the_same(spark):
    docs, items, df, benchmark = tables(spark, 2)
    assert found(df, benchmark, block_bytes=600) == brute.leaks(docs, items)


def test_empty_tables(spark):
    docs, _, df, benchmark = tables(spark)
    none = benchmark.limit(0)
    assert found(df, none) == brute.leaks(docs, [])
    assert found(df.limit(0), benchmark) == []


def test_remove_keeps_clean_rows_and_their_columns(spark):
    rows = [(1, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11", 3), (2, "clean text", 4), (3, None, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words int")
    for item, left in (("w3 w4 w5 w6 w7 w8 w9 w10 w11 w12", rows), ("w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12", rows[1:])):
        items = spark.createDataFrame([(1, item)], "item_id long, text string")
        kept = decontaminate.remove_contaminated(df, items)
        assert [tuple(r) for r in kept.orderBy("doc_id").collect()] == left
