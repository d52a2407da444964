"""Grouped medians against brute force."""

import math

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tripfare.operators.history import MEDIANS
from tripfare.operators import quantiles
from tripfare.operators.quantiles import grouped_medians, medians_of, rolled_up, value_counts


def brute(values):
    known = sorted((v for v in values if v is not None), key=lambda v: (math.isnan(v), v))
    return known[(len(known) - 1) // 2] if known else None


def same(a, b):
    if a is None or b is None:
        return a is b
    return a == b or (math.isnan(a) and math.isnan(b))


numbers = st.one_of(
    st.none(),
    st.floats(allow_nan=True, allow_infinity=True),
    st.floats(min_value=0, max_value=100),
    st.integers(-5, 5).map(float),
)
trips = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 2)), st.integers(0, 1), numbers, numbers), min_size=1, max_size=60)


def check(found, data, keyed=True):
    found = {(r.a, r.b) if keyed else (): (r.historical_distance, r.historical_duration) for r in found.collect()}
    groups = {t[:2] for t in data} if keyed else {()}
    assert set(found) == groups
    for group in groups:
        mine = [t for t in data if not keyed or t[:2] == group]
        want = tuple(brute([t[i] for t in mine]) for i in (2, 3))
        assert all(same(x, y) for x, y in zip(found[group], want)), (group, found[group], want)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(trips)
def test_any_values_any_groups(spark, data):
    frame = spark.createDataFrame(data, "a int, b int, trip_distance double, duration_minutes double")
    check(grouped_medians(frame, ["a", "b"], MEDIANS), data)
    check(grouped_medians(frame, [], MEDIANS), data, keyed=False)
    counts = value_counts(frame, ["a", "b"], MEDIANS)
    check(medians_of(rolled_up(counts), [], list(MEDIANS)), data, keyed=False)


def test_one_group_with_a_third_of_many_copies(spark):
    frame = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"),
        F.when(F.col("id") % 3 == 0, 7.25).otherwise(F.col("id") % 977 / 10).alias("x"),
    )
    got = grouped_medians(frame, ["k"], {"m": "x"})
    exact = frame.groupBy("k").agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY x)").alias("m"))
    assert sorted(map(tuple, got.select("k", "m").collect())) == sorted(map(tuple, exact.collect()))


def stored(monkeypatch, frame):
    """The median of x, and the tables stored on the way by label."""
    kept, store = {}, quantiles.durable
    monkeypatch.setattr(quantiles, "durable", lambda f, label: kept.setdefault(label, store(f, label)))
    return grouped_medians(frame, ["k"], {"m": "x"}).first().m, kept


def narrow(spark):
    return spark.range(40_000).select(F.lit(1).alias("k"), (1000 + F.col("id") / 1e6).alias("x"))


def test_only_values_inside_the_bracket_are_kept(spark):
    frame = narrow(spark)
    brackets = quantiles._bracketed(frame, ["k"], ["x"])
    inside = quantiles._inside(frame, brackets, ["k"], ["x"]).collect()
    assert 0 < sum(r.size for r in inside if r.value is not None) < 400
    assert grouped_medians(frame, ["k"], {"m": "x"}).first().m == 1000 + 19_999 / 1e6


def test_a_large_group_in_a_narrow_range_is_cut_into_parts(spark, monkeypatch):
    """As where a bracket holds more values than a task may count through."""
    monkeypatch.setattr(quantiles, "INSIDE_VALUES", 0)
    found, kept = stored(monkeypatch, narrow(spark))
    assert found == 1000 + 19_999 / 1e6
    assert kept["ordered-values"].count() == 40_000


@pytest.mark.parametrize("bracket", [(0.1, 0.2), (0.7, 0.9)])
def test_a_bracket_that_misses_is_found_out(spark, monkeypatch, bracket):
    monkeypatch.setattr(quantiles, "BRACKET", bracket)
    frame = narrow(spark).withColumn("k", F.when(F.col("x") < 1000.01, 1))
    exact = {r.k: r.m for r in frame.groupBy("k").agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY x)").alias("m")).collect()}
    assert {r.k: r.m for r in grouped_medians(frame, ["k"], {"m": "x"}).collect()} == exact
    found, kept = stored(monkeypatch, narrow(spark))
    assert found == 1000 + 19_999 / 1e6 and "ordered-values" in kept


def test_many_groups_are_not_sent_to_all(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "fits_broadcast", lambda lookup: False)
    frame = spark.range(3_000).select(F.when(F.col("id") % 7 > 0, F.col("id") % 50).alias("k"), (F.col("id") * 31 % 1009).cast("double").alias("x"))
    exact = {r.k: r.m for r in frame.groupBy("k").agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY x)").alias("m")).collect()}
    assert {r.k: r.m for r in grouped_medians(frame, ["k"], {"m": "x"}).collect()} == exact


def test_groups_without_values_stay_whatever_their_size(spark):
    for rows in (10, 6_000):
        frame = spark.range(rows).select(F.lit(1).alias("k"), F.lit(None).cast("double").alias("x"))
        assert [tuple(r) for r in grouped_medians(frame, ["k"], {"m": "x"}).collect()] == [(1, None)]


def test_the_middle_of_even_counts_is_the_lower_one(spark):
    frame = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "x double").withColumn("k", F.lit(1))
    assert grouped_medians(frame, ["k"], {"m": "x"}).first().m == 2.0
