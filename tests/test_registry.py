"""Every registered query with SQL gives the same rows in Spark and in DuckDB."""

import sys

import duckdb
import pytest

from opinara.registry import ORACLES, QUERIES
from tools.compare import TABLES, rows_of


@pytest.fixture(scope="module")
def duck(folder):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, folder, name):
    df = QUERIES[name](spark, folder)
    result = duck.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, result.fetchall())


def test_entry_points_without_the_text_operators(monkeypatch):
    import importlib

    import __spark_entry__ as entry

    with monkeypatch.context() as patch:
        patch.setitem(sys.modules, "corpus_pipeline", None)
        importlib.reload(entry)
        assert entry.queries() == QUERIES and entry.oracle_sql() == ORACLES
    importlib.reload(entry)


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 6
    assert set(entry.oracle_sql()) <= set(entry.queries())
