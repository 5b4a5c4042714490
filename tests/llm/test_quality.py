import random

from pyspark.sql import functions as F

from perennial.llm import quality
from tests.llm import brute

ODD = [
    None, "", " \n\t", "one", "a b", "a b c", "a b c a b c", "a a a a a", "x\n\nx\n \nx", "a\x0bb\x0cc\xa0d", "é ü z",
    "#*$%&|<> <|x|>", "same line here\nsame line here\n same line here", "w " * 40_000, " ".join(str(i % 7000) for i in range(20_000)),
]


def test_measures_are_those_of_plain_counting(spark):
    rng = random.Random(4)
    rows = [(i, t) for i, t in enumerate(ODD)]
    rows += [(100 + i, " ".join(rng.choice("ab c\n d e".split(" ")) for _ in range(rng.randint(0, 90)))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r[0]: tuple(r[1:]) for r in quality.measure(df).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()}
    for i, text in rows:
        assert out[i] == brute.measures(text), repr(text)[:80]


def test_colliding_hash_bits_are_told_apart(spark):
    # windows meet by 32 bits first: so few bits that many meet
    df = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(120_000)))], "doc_id long, text string")
    assert quality.measure(df).first()["n_repeat_words"] == 0


def test_policies_and_ablation_follow_the_ledger(spark):
    good = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
    rows = [(1, good), (2, "few words"), (3, good.replace(" ", " | ")), (4, "No! " * 60), (4, "No! " * 60), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    book = quality.ledger(df)
    kept = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in quality.apply_policy(book, "v2").collect()}
    assert kept == {1: (False, True), 2: (True, False), 3: (False, False), 4: (True, False), None: (True, False)}
    base = {r["doc_id"]: r["kept"] for r in quality.apply_policy(book, "base").collect()}
    assert base[3] is True
    effect = {r["rule"]: tuple(r[1:]) for r in quality.ablation(book, "v2").collect()}
    bits = [r["fail_bits"] for r in book.collect()]
    for number, rule in enumerate(quality.RULES):
        bit = 1 << number
        assert effect[rule] == (
            sum(1 for b in bits if b & bit),
            sum(1 for b in bits if b == bit),
            sum(1 for b in bits if not b & ~bit),
        )


def test_native_plan_and_clashing_names(spark):
    df = spark.createDataFrame([(1, "a b", 7, "k")], "doc_id long, text string, n_words int, kept string")
    out = quality.apply_policy(quality.ledger(df))
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    assert out.columns.count("kept") == 1 and out.first()["n_words"] == 2
    assert quality.apply_policy(quality.ledger(df.limit(0))).count() == 0
    assert quality.ablation(quality.ledger(df.limit(0))).agg(F.sum("n_failed")).first()[0] is None


def test_a_filter_does_not_repeat_the_measurements(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    kept = quality.apply_policy(quality.ledger(df)).where("kept").select("doc_id", "text")
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    # words, symbols, exclamation marks and digits, once each
    assert plan.count("regexp_extract_all") == 4
