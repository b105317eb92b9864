import duckdb
import pytest
from conftest import SMALL

import __spark_entry__ as entry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
# 24 points in two folds take minutes even on the smallest table; test_ml.py has the same steps.
SLOW = {"grid_metrics"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return con


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


# The queries of the training-data operators are tested with them.
OWN = set(entry.all_queries()) - SLOW


@pytest.mark.parametrize("name", sorted(OWN))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SMALL)
    rows = [tuple(r) for r in df.collect()]
    assert rows
    sql = entry.oracle_sql().get(name)
    if sql:
        result = duck.execute(sql)
        columns = [d[0] for d in result.description]
        assert sorted(columns) == sorted(df.columns)
        assert _sorted_rows(df.columns, rows) == _sorted_rows(columns, result.fetchall())


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).columns == ["category", "rk", "term", "chi2"]
