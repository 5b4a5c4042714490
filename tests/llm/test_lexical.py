import math
import random
from collections import Counter

from perennial.llm import lexical
from tests.llm.brute import FOLD, ITEM_WORD


def plain(docs, items, best=10):
    """All scores, row by row."""
    split = lambda t: ITEM_WORD.findall((t or "").translate(FOLD))
    sized = [(i, ws) for i, t in docs if (ws := split(t))]
    n_docs, total = len(sized), sum(len(ws) for _, ws in sized)
    bags = [(i, len(ws), Counter(ws)) for i, ws in sized]
    df = Counter(t for _, _, bag in bags for t in bag)
    out = []
    for item, text in items:
        scored = []
        for i, n, bag in bags:
            m = 100 - 90 + (90 * n * n_docs) // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * bag[t]) // (1000 * bag[t] + 8 * m))
                for t in set(split(text)) & bag.keys()
            )
            if score > 0:
                scored.append((-score, i is None, i, score))
        scored.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, place, i, score) for place, (_, _, i, score) in enumerate(scored[:best], 1)]
    return sorted(out, key=repr)


def tables(spark, docs, items):
    return (
        spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as n", "2 as terms", "3 as HASH", "4 as m"),
        spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "5 as item", "6 as rank"),
    )


def sample(seed=1):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["É", "ü9", "10"]
    text = lambda n: "".join(rng.choice(words) + rng.choice([" ", "\n", "-", "_", "  "]) for _ in range(n))
    docs = [(i, text(rng.randint(0, 30))) for i in range(150)] + [(500, None), (501, ""), (502, " -- "), (None, "w1 w2"), (None, "w1 w2")]
    docs += [(900 - i, "W3 w4 rare") for i in range(40)] + [(77, "w3 w4 rare"), (77, "w3 w4 rare")]
    items = [(i, text(rng.randint(0, 8))) for i in range(12)] + [(5, "w3 RARE"), (5, "w3 RARE"), (None, "w1"), (90, None), (91, "unknown"), (92, "")]
    return docs, items


def test_ranking_is_that_of_plain_scoring(spark):
    docs, items = sample()
    out = lexical.rank(*tables(spark, docs, items))
    assert sorted((tuple(r) for r in out.collect()), key=repr) == plain(docs, items)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]


def test_blocks_of_items_and_small_pieces_change_nothing(spark, monkeypatch):
    docs, items = sample(2)
    monkeypatch.setattr(lexical, "PAIRS", 7)
    monkeypatch.setattr(lexical, "CHUNK", 16)
    frames = tables(spark, docs, items)
    out = lexical.rank(frames[0].repartition(5), frames[1], best=3, block_bytes=300)
    assert sorted((tuple(r) for r in out.collect()), key=repr) == plain(docs, items, 3)


def test_a_hot_class_is_scored_once(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "if(id % 3 = 0, 'same rare words', concat('other ', id)) as text").repartition(9)
    items = spark.createDataFrame([(1, "rare words")], "item_id long, text string")
    assert [r["doc_id"] for r in lexical.rank(docs, items).orderBy("rank").collect()] == [3 * i for i in range(10)]
    sent = spark.sparkContext.broadcast(lexical.Block([(0, "rare words")]))
    grouped = lexical.classes(lexical.bags(docs, sent), 4000, 9333)
    assert [len(r["members"]) for r in grouped.collect()] == [10]
    assert "WindowGroupLimit" in grouped._jdf.queryExecution().toString()


def test_words_over_the_chunk_border_are_whole(monkeypatch):
    monkeypatch.setattr(lexical, "CHUNK", 3)
    assert lexical.counted("abcdef Ab-ab xyz") == {b"abcdef": 1, b"ab": 2, b"xyz": 1}
    assert not lexical.counted(None) and not lexical.counted("")


def test_empty_tables_and_a_very_long_text(spark):
    docs, items = tables(spark, [(1, "w " * 600_000 + "rare")], [(1, "w"), (2, "rare")])
    assert lexical.rank(docs.limit(0), items).count() == 0
    assert lexical.rank(docs, items.limit(0)).count() == 0
    assert sorted(tuple(r) for r in lexical.rank(docs, items).collect()) == plain([(1, "w " * 600_000 + "rare")], [(1, "w"), (2, "rare")])
