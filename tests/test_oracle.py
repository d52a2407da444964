"""Every query that SQL can express gives the rows of its SQL."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from checks import oracle, queries, replays

QUERIES = queries.QUERIES | replays.QUERIES
ORACLE = oracle.ORACLE | replays.ORACLE
SF = "/root/testdata/sf0.001"
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def ordered(data):
    return sorted(data, key=lambda row: tuple(repr(v) for v in row))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    frame = QUERIES[name](spark, SF)
    columns = sorted(frame.columns)
    answer = duck.sql(ORACLE[name])
    assert sorted(answer.columns) == columns
    kinds = dict(zip(answer.columns, map(str, answer.types)))
    assert {c: TYPES[t] for c, t in frame.dtypes} == kinds
    where = [answer.columns.index(c) for c in columns]
    expected = ordered(tuple(r[i] for i in where) for r in answer.fetchall())
    assert ordered(map(tuple, frame.select(*columns).collect())) == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_other_queries_give_finite_rows(spark, name):
    found = QUERIES[name](spark, SF).collect()
    assert found
    for row in found:
        assert all(math.isfinite(v) for v in row if isinstance(v, float))


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
