"""The lookup join gives the plain join's rows on every path."""

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tripfare.operators import joins
from tripfare.sources import adapters

KEYS = ["a", "b"]


@pytest.fixture(scope="module")
def sides(spark):
    """A third of the facts share one key, a sixth are one row copied, some keys are NULL or unknown."""
    rng = random.Random(7)
    facts = [(1, 1, i) for i in range(400)] + [(2, 2, -1)] * 200
    facts += [(None, 1, i) for i in range(50)] + [(1, None, i) for i in range(50)] + [(99, 99, i) for i in range(100)]
    facts += [(rng.randrange(20), rng.randrange(20), i) for i in range(400)]
    lookup = [(a, b, a * 100.0 + b) for a in range(15) for b in range(15)] + [(None, 1, -5.0)]
    return (
        spark.createDataFrame(facts, "a int, b int, f int").repartition(6),
        spark.createDataFrame(lookup, "a int, b int, v double"),
    )


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("hot", [None, [], [(1, 1), (2, 2), (99, 99)], [(1, 1)]])
def test_every_path_equals_the_plain_join(sides, how, hot):
    facts, lookup = sides
    plain = rows(facts.join(lookup, KEYS, how), "a", "b", "f", "v")
    broadcast = joins.lookup_join(facts, lookup, KEYS, how)
    split = joins.lookup_join(facts, lookup, KEYS, how, broadcast_limit=0, hot=hot)
    assert rows(broadcast, "a", "b", "f", "v") == plain
    assert rows(split, "a", "b", "f", "v") == plain


def test_hot_keys_are_the_frequent_ones(sides):
    facts, _ = sides
    assert sorted(joins.hot_keys(facts, KEYS, share=0.08, sample=1)) == [(1, 1), (2, 2), (99, 99)]
    assert len(joins.hot_keys(facts, KEYS, share=0.01, sample=1)) <= 100
    assert joins.hot_keys(facts.filter("false"), KEYS) == []


def test_hot_rows_are_not_shuffled(sides):
    facts, lookup = sides
    plan = joins.lookup_join(facts, lookup, KEYS, broadcast_limit=0, hot=[(1, 1)])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_only_a_proven_size_is_broadcast(spark, sides):
    _, lookup = sides
    assert joins.fits_broadcast(lookup)
    assert not joins.fits_broadcast(lookup, limit=100)
    assert not joins.fits_broadcast(lookup, rows=10**9)
    # A text column has no width bound.
    assert not joins.fits_broadcast(lookup.withColumn("name", F.lit("x")), rows=1)


def test_single_key_and_bad_join_type(spark):
    facts = spark.createDataFrame([(1,), (1,), (None,), (3,)], "k int")
    lookup = spark.createDataFrame([(1, 2.0)], "k int, v double")
    found = joins.lookup_join(facts, lookup, ["k"], broadcast_limit=0, hot=[(1,)])
    assert rows(found, "k", "v") == [(None, None), (1, 2.0), (1, 2.0), (3, None)]
    with pytest.raises(ValueError, match="left or inner"):
        joins.lookup_join(facts, lookup, ["k"], "full")


def test_order_trips_are_the_same_beyond_every_broadcast(spark, sf, monkeypatch):
    small = rows(adapters.order_trips(spark, sf))
    monkeypatch.setattr(joins, "fits_broadcast", lambda *_, **__: False)
    large = adapters.order_trips(spark, sf)
    plan = large._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Cartesian" not in plan
    assert rows(large) == small
