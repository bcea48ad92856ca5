"""Every registered query against its DuckDB SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


OWN = list(contract._QUERIES)  # those of the star schema; others have tests of their own


def test_every_query_has_sql():
    assert set(OWN) <= contract.oracle_sql().keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", OWN)
def test_matches_sql(spark, duck, name):
    ours = contract.queries()[name](spark, SF).toArrow()
    theirs = duck.execute(contract.oracle_sql()[name]).to_arrow_table()
    columns = sorted(ours.column_names)
    assert columns == sorted(theirs.column_names)
    types = [[str(t.schema.field(c).type) for c in columns] for t in (ours, theirs)]
    assert types[0] == types[1]
    values = [
        sorted(tuple(str(row[c]) for c in columns) for row in t.to_pylist()) for t in (ours, theirs)
    ]
    assert values[0] and values[0] == values[1]


def test_entry(spark):
    assert contract.entry(spark).count() > 0
