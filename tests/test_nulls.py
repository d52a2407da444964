"""Missing values: no row is lost, and the SQL agrees."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from checks.oracle import ORACLE
from checks.queries import QUERIES
from tripfare.sources import adapters

SF = "/root/testdata/sf0.001"
HOLES = {
    "events": ["user_id", "ts", "value", "event_type"],
    "orders": ["o_custkey", "o_orderdate"],
    "lineitem": ["l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice"],
}


@pytest.fixture(scope="module")
def holey(spark, tmp_path_factory):
    """The test tables with every ninth value of each column missing, some keys unknown, some JSON broken."""
    folder = tmp_path_factory.mktemp("holes")
    for name in ("events", "orders", "lineitem", "customer", "supplier"):
        frame = spark.read.parquet(f"{SF}/{name}.parquet")
        for i, column in enumerate(HOLES.get(name, [])):
            gone = F.pmod(F.xxhash64(*frame.columns[:2], F.lit(i)), F.lit(9)) == 0
            frame = frame.withColumn(column, F.when(~gone, F.col(column)))
        if name == "events":
            frame = frame.withColumn("props", F.when(F.col("event_id") % 7 == 0, '{"k": "x1"}').otherwise(F.col("props")))
        if name in ("customer", "supplier"):
            frame = frame.filter(F.xxhash64(frame.columns[0]) % 5 != 0)
        frame.coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def duck(holey):
    connection = duckdb.connect()
    for name in ("events", "orders", "lineitem", "customer", "supplier"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{holey}/{name}.parquet/*.parquet'")
    return connection


@pytest.mark.parametrize(
    "name",
    ["trip_duration", "quality_counts", "quality_counts_events", "normalize_trips", "rmse_selection", "route_medians", "route_history"],
)
def test_query_equals_sql_with_missing_values(spark, holey, duck, name):
    frame = QUERIES[name](spark, holey)
    columns = sorted(frame.columns)
    answer = duck.sql(ORACLE[name])
    where = [answer.columns.index(c) for c in columns]
    key = lambda row: tuple(repr(v) for v in row)
    assert sorted(map(tuple, frame.select(*columns).collect()), key=key) == sorted(
        (tuple(r[i] for i in where) for r in answer.fetchall()), key=key
    )


def test_one_busy_hour_is_spread_and_right(spark):
    draw = random.Random(3)
    rows = [(i, 1 if i % 3 == 0 else draw.randrange(2, 9), draw.randrange(3_600_000_000)) for i in range(3_000)]
    events = spark.createDataFrame(rows, "event_id long, user_id long, micros long").select(
        "event_id", "user_id", F.timestamp_micros("micros").cast("timestamp_ntz").alias("ts")
    )
    found = {r.event_id: r.next_ts for r in adapters.with_next(events).collect()}
    stamps = {r.event_id: r.ts for r in events.collect()}
    for user in {u for _, u, _ in rows}:
        mine = sorted((stamps[i], i) for i, u, _ in rows if u == user)
        for (_, i), (later, _) in zip(mine, mine[1:]):
            assert found[i] == later
        assert found[mine[-1][1]] is None
