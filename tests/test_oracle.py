"""Every registered query against DuckDB on the same tables; queries without SQL must return rows with a stable schema."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        return "" if v is None or (isinstance(v, float) and math.isnan(v)) else str(v)

    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(name, spark, duck):
    df = QUERIES[name](spark, SF)
    got = canonical([tuple(r) for r in df.collect()], df.columns)
    result = duck.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert got == canonical(result.fetchall(), columns)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(name, spark):
    df = QUERIES[name](spark, SF)
    assert df.count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
