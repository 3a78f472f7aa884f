"""Every registered query against its SQL over the same tables."""

import duckdb
import pytest

import __spark_entry__ as entry_point
from shardstream.plans.oracles import ORACLES
from shardstream.plans.queries import QUERIES
from tests.helpers import rows

FOLDER = "/root/testdata/sf0.01"
TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "int": "INTEGER", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.sql(f"create view events as select * from '{FOLDER}/events.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= entry_point.queries().items()
    assert ORACLES.items() <= entry_point.oracle_sql().items()


def test_entry(spark):
    result = entry_point.entry(spark)
    assert result.count() == 4
    assert set(result.columns) >= {"shard_id", "committed", "max_millis_behind"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_as_sql(name, spark, duck):
    sql = ORACLES[name]
    result = QUERIES[name](spark, FOLDER)
    expected = duck.sql(sql)
    columns = sorted(result.columns)
    assert sorted(expected.columns) == columns
    types = dict(zip(expected.columns, map(str, expected.types), strict=True))
    assert {c: TYPES[t] for c, t in result.dtypes} == types
    want = duck.sql(f"select {', '.join(columns)} from ({sql})").fetchall()
    assert rows(result, *columns) == sorted(want, key=lambda r: tuple((v is not None, str(v)) for v in r))
