"""Queries that SQL can express, against that SQL."""

import duckdb
import pytest

from shardstream.llm.oracles import ORACLES
from shardstream.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings"):
        duck.sql(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    expected = duck.sql(ORACLES[name])
    result = QUERIES[name](spark, FOLDER)
    assert result.columns == expected.columns
    assert sorted(map(tuple, result.collect())) == sorted(expected.fetchall())
