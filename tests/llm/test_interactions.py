import re
from itertools import permutations

import pytest

from perennial.llm import interactions
from perennial.sources import buckets

FIELDS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def plain(rows, labels):
    """The report by going through every order row by row."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    firsts = {}
    for i, text, _ in rows:
        if i is not None:
            firsts[text or ""] = min(i, firsts.get(text or "", i))
    judged = []
    for i, text, lang in rows:
        t = text or ""
        ws = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(ws) < 200,
            "B": 100 * len(set(ws)) < 50 * len(ws),
            "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)),
            "E": i is not None and firsts[t] < i,
        }
        judged.append((lang or "", {k for k, v in fails.items() if v}, i in good, i in toxic))
    out = {}
    for part in {j[0] for j in judged}:
        here = [j for j in judged if j[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = here
            for step, name in enumerate(order, 1):
                gone = [j for j in left if name in j[1]]
                left = [j for j in left if name not in j[1]]
                shapley[name] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(name in j[1] for j in here) - len(gone), sum(j[1] == {name} for j in here),
                    sum(j[2] for j in gone), sum(j[3] for j in gone),
                ]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return out


def test_report_is_that_of_plain_counting(spark):
    good = " ".join(f"word{i}" for i in range(220))
    texts = [None, "", " \n", "ABC", "a # b", good, good, good + " #", good.upper(), "x " * 300, "X " * 300, "é" * 50, good + "\tB" * 90]
    rows = [(i, t, ["en", None, "", "de"][i % 4]) for i, t in enumerate(texts * 3)]
    rows += [(None, good, "en"), (None, good, "en"), (7, "other", "de"), (7, "other", "de"), (1, "b " * 9, None)]
    labels = [(i, i % 2, i % 3 % 2) for i in range(30)] + [(3, None, 1), (3, 1, None), (None, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    named = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = interactions.audit(docs.selectExpr("*", "1 as row", "'x' as part", "2 as past", "3 as Filter", "4 as words"), named)
    assert {tuple(r)[:3]: list(r)[3:] for r in out.collect()} == plain(rows, labels)
    assert out.columns == ["part", "filter_order", "step", *FIELDS]


def test_a_hot_group_of_copies_and_one_very_long_text(spark):
    rows = [(i, "same text", "en") for i in range(3000)] + [(9000, "Long # " * 200_000, "en"), (9001, "alone", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(7)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = {(r["filter_order"], r["step"]): r for r in interactions.audit(docs, none).collect()}
    assert out["EABCD", 1]["removed"] == 2999 and out["EABCD", 1]["kept"] == 3
    assert out["AEBCD", 2]["redundant"] == 2999 and out["AEBCD", 2]["removed"] == 0
    assert out["ABCDE", 1]["unique_fails"] == 2


def test_other_filters_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b", "en"), (2, "A", "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = interactions.audit(docs, labels, {"w": "n_words < 2", "c": "n_capitals > 0"})
    assert sorted((r["filter_order"], r["step"], r["kept"], r["removed"], r["redundant"]) for r in out.collect()) == [
        ("cw", 1, 1, 1, 0), ("cw", 2, 1, 0, 1), ("wc", 1, 1, 1, 0), ("wc", 2, 1, 0, 1),
    ]
    assert interactions.audit(docs.limit(0), labels).count() == 0
    with pytest.raises(ValueError):
        interactions.audit(docs, labels, {"long": "true"})


def test_joins_on_ids_move_no_rows(spark):
    base = buckets.store(spark.range(50).selectExpr("id as row", "'p' as part", "0L as good", "0L as toxic"), "base", ["row"])
    ids = buckets.store(spark.range(50).selectExpr("id as row", "'p' as part", "if(id % 2 = 0, 'a', 'b') as filter", "1 + id % 2 as bit"), "ids", ["row"])
    left = interactions._survivors(spark.table(base), spark.table(ids), ["a", "b"])
    plan = left._jdf.queryExecution().toString()
    assert plan.count("SortMergeJoin") >= 2 and "Exchange" not in plan
    kept = buckets.store(left, "kept", ["row"])
    plan = interactions._counts(spark.table(kept), spark.table(ids), ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    # rows leave their bucket as counts only
    assert plan.count("SortMergeJoin") == 2 and plan.count("Exchange hashpartitioning(row") == 0
    buckets.drop(spark, kept)
    buckets.drop(spark, base, ids)
