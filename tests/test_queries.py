"""Registered queries against their oracle SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from checks.oracles import SQL
from checks.queries import REGISTRY

DIR = entry.SMOKE_DIR
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    return con


def comparable(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_same_rows(spark, duck, name):
    df = entry.queries()[name](spark, DIR)
    columns = sorted(df.columns)
    rel = duck.execute(entry.oracle_sql()[name])
    names = [c[0] for c in rel.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    want = comparable([tuple(r[i] for i in places) for r in rel.fetchall()])
    assert comparable([tuple(r[c] for c in columns) for r in df.collect()]) == want


def test_every_query_has_an_oracle():
    assert set(SQL) == set(REGISTRY)
    assert set(SQL) <= set(entry.oracle_sql())
    assert set(REGISTRY) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
