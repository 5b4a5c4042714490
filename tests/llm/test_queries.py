"""The registered queries against their SQL, and the pipeline's stages against brute force."""

import duckdb
import pytest

import corpus_pipeline
from perennial.llm import oracles, queries
from tests.llm import brute

TABLES = "documents pages benchmark conversations labels".split()


@pytest.mark.parametrize("key", sorted(oracles.oracle_sql()))
def test_query_matches_its_sql(spark, sf_dir, key):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    df = queries.queries()[key](spark, sf_dir)
    cursor = con.execute(oracles.oracle_sql()[key])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    theirs = sorted(repr([row[names.index(c)] for c in df.columns]) for row in cursor.fetchall())
    assert sorted(repr(list(row)) for row in df.collect()) == theirs


def test_every_operator_has_one_query():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.queries()) == list(range(1, 14))


def test_stages_do_their_work(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    benchmark = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    stages = dict(corpus_pipeline.STAGES)
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}

    kept = stages["quality rules"](spark, docs, sf_dir)
    assert kept.columns == docs.columns
    for r in kept.collect():
        n, _, symbols, _, repeated = brute.measures(r["text"])
        assert n >= 50 and 2 * repeated <= n and 10 * symbols <= n
    lost = set(rows) - {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert all(any((m[0] < 50, 2 * m[4] > m[0], 10 * m[2] > m[0], m[3] > 0)) or "!" in rows[i] for i in lost for m in [brute.measures(rows[i])])

    lined = stages["line dedup"](spark, kept, sf_dir)
    assert lined.columns == docs.columns
    for r in lined.collect():
        assert r["n_chars"] == len(r["text"]) and set(r["text"].split("\n")) <= set(rows[r["doc_id"]].split("\n")) | {""}

    single = stages["near dedup"](spark, lined, sf_dir)
    assert single.columns == docs.columns
    wanted = {i for i, _, _, first in brute.components([(r["doc_id"], r["text"]) for r in lined.collect()]) if first}
    assert {r["doc_id"] for r in single.collect()} == wanted

    clean = stages["decontamination"](spark, single, sf_dir)
    assert clean.columns == docs.columns
    leaks = brute.leaks([(r["doc_id"], r["text"]) for r in single.collect()], benchmark)
    assert {r["doc_id"] for r in clean.collect()} == {i for i, _, hit, _ in leaks if not hit}

    packed = stages["best-fit packing"](spark, clean, sf_dir).collect()
    assert {r["doc_id"] for r in packed} == {i for i, _, hit, _ in leaks if not hit}
    n_sequences = len({r["sequence_id"] for r in packed})
    assert n_sequences <= -(-sum(r["length"] for r in packed) // 2048) + 1


def test_pipeline_runs_and_stands_on_no_table(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.count() > 0
    assert corpus_pipeline.ORACLE_SQL is None
    empty = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, function in corpus_pipeline.STAGES:
        assert function(spark, empty, sf_dir).count() == 0
