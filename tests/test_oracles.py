"""Every registered query against its SQL counterpart on the same tables."""

import duckdb
import pytest

from perennial.plans import catalog, oracles

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = sorted(tuple(repr(row[i]) for i in order) for row in rows)
    return [columns[i] for i in order], cells


@pytest.mark.parametrize("key", sorted(oracles.oracle_sql()))
def test_query_matches_oracle(spark, sf_dir, duck, key):
    df = catalog.queries()[key](spark, sf_dir)
    mine = canonical(df.columns, [tuple(r) for r in df.collect()])
    cursor = duck.execute(oracles.oracle_sql()[key])
    theirs = canonical([d[0] for d in cursor.description], cursor.fetchall())
    assert mine[0] == theirs[0]
    assert len(mine[1]) == len(theirs[1])
    assert mine[1] == theirs[1]


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(oracles.oracle_sql())
