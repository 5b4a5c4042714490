import random

from perennial.llm import components, minhash
from tests.llm import brute


def found(df):
    return sorted(tuple(r) for r in minhash.link(df).collect())


def family(rng, base, n, edits):
    """Copies of a text with up to ``edits`` words changed."""
    out = []
    for _ in range(n):
        words = base.split()
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(len(words))] = f"z{rng.randint(0, 10**6)}"
        out.append(" ".join(words))
    return out


def say(rng, n):
    return " ".join(f"w{rng.randint(0, 3000)}" for _ in range(n))


def documents(seed):
    rng = random.Random(seed)
    texts = [say(rng, rng.randint(0, 120)) for _ in range(60)]
    for n, size, edits in ((40, 200, 8), (12, 100, 2), (5, 60, 1), (30, 400, 25)):
        texts += family(rng, say(rng, size), n, edits)
    texts += [texts[70]] * 3 + ["", " \n", None, "one two", "One TWO", "one two three", "é " * 9]
    rng.shuffle(texts)
    return [(i * 3 + 1, t) for i, t in enumerate(texts)]


def test_components_are_those_of_all_pairs(spark):
    rows = documents(1)
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute.components(rows)


def test_large_buckets_lose_no_link(spark, monkeypatch):
    # every bucket of three is large: leaders first, the rest by rare shingles
    monkeypatch.setattr(minhash, "SMALL", 2)
    rows = documents(2)
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute.components(rows)


def test_a_passage_that_many_share_links_nothing(spark, monkeypatch):
    monkeypatch.setattr(minhash, "SMALL", 3)
    rng = random.Random(8)
    passage = say(rng, 60)
    rows = [(i, say(rng, rng.randint(8, 60)) + " " + passage) for i in range(80)]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute.components(rows)


def test_threshold_is_exact(spark):
    # 100 shingles; the other keeps 75 of 100, or 74 of 100, of the union
    base = [f"a{i}" for i in range(104)]
    rows = [(1, " ".join(base)), (2, " ".join(base[:79])), (3, " ".join(base[25:])), (10, "b " + " ".join(base[26:]))]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute.components(rows)


def test_repeated_rows_null_ids_and_empty_table(spark):
    text = say(random.Random(3), 50)
    df = spark.createDataFrame([(5, text, 1), (5, text, 1), (7, text, 2), (None, text, 3)], "doc_id long, text string, n_shingles int")
    out = sorted(((r["id"], r["component_id"], r["kept"]) for r in minhash.link(df).collect()), key=repr)
    assert out == [(5, 5, True), (5, 5, True), (7, 5, False), (None, 5, True)] or out == [
        (5, 5, True), (5, 5, True), (7, 5, False), (None, None, True)
    ]
    kept = minhash.keep_one(df)
    assert kept.columns == df.columns and sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 5, 5]
    assert found(df.limit(0)) == []


def test_given_documents(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    assert found(df) == brute.components([tuple(r) for r in df.collect()])


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(6)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(1, i) for i in range(2, 40)]
    other = [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)] + [(7, 7), (1, 2)]
    edges = chain + star + other
    root = {x: x for e in edges for x in e}
    for _ in range(100):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    linked = {x for a, b in edges if a != b for x in (a, b)}
    out = components.components(spark.createDataFrame(edges, "u long, v long"))
    assert sorted(map(tuple, out.collect())) == sorted((x, root[x]) for x in linked)


def test_sets_of_one_template_never_meet(spark):
    # sets of 100 with 80 shingles of a template: 0.67 alike, of which the rarest six shared ones are looked up
    rare = spark.range(3000).selectExpr("id", "id as label", "100L as n", "explode(sequence(0, 5)) as pos").selectExpr(
        "id", "label", "n", "cast(pos as long) as item", "80L - pos as left"
    )
    assert minhash._meeting(rare).count() == 0
    # sets that may be links still meet, once from the larger one
    three = [(1, 1, 100, 7, 90), (2, 2, 90, 7, 90), (3, 3, 70, 7, 70)]
    pair = spark.createDataFrame(three, "id long, label long, n long, item long, left long")
    met = {(r["id_a"], r["id_b"]) for r in minhash._meeting(pair).where("id_a <> id_b").collect()}
    assert met == {(1, 2), (2, 3)}
