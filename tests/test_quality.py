import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tripfare.config import Limits
from tripfare.functions.rules import REASONS
from tripfare.operators import quality
from tripfare.sources import adapters

NAN, INF = math.nan, math.inf

# Cases follow from the limits: on each bound, one step beyond it, and what is no number.
LIMITS = Limits()
STEP = 0.25
(SHORTEST, LONGEST), FARTHEST, FASTEST, DEAREST = LIMITS.minutes, LIMITS.max_miles, LIMITS.max_mph, LIMITS.max_fare
GOOD = {"distance": 3.0, "minutes": 20.0, "fare": 15.0}


def case(expected, **values):
    found = GOOD | values
    return (found["distance"], found["minutes"], found["fare"], expected)


NO_AMOUNT = (None, NAN, -INF, -STEP, 0.0)
CASES = [
    case("accepted"),
    case("accepted", minutes=SHORTEST, distance=STEP),
    case("accepted", minutes=LONGEST),
    case("accepted", distance=FARTHEST, minutes=LONGEST),
    case("accepted", fare=DEAREST),
    case("accepted", fare=STEP),
    case("accepted", distance=FASTEST / 2, minutes=30.0),
    case("speed_over_limit", distance=FASTEST / 2 + STEP, minutes=30.0),
    *[case("distance_missing_or_nonpositive", distance=d) for d in NO_AMOUNT],
    *[case("distance_over_limit", distance=d) for d in (FARTHEST + STEP, INF)],
    *[case("duration_too_short", minutes=m) for m in (SHORTEST - STEP, 0.0, -SHORTEST)],
    case("duration_too_long", minutes=LONGEST + STEP),
    *[case("fare_missing_or_nonpositive", fare=f) for f in NO_AMOUNT],
    *[case("fare_over_limit", fare=f) for f in (DEAREST + STEP, INF)],
    # Of several faults the first rule names the trip.
    case("distance_missing_or_nonpositive", distance=NAN, minutes=0.0, fare=INF),
    case("distance_over_limit", distance=INF, minutes=LONGEST + STEP, fare=None),
    case("duration_too_short", minutes=0.0, fare=0.0),
    case("speed_over_limit", distance=FARTHEST, minutes=SHORTEST, fare=NAN),
]
SCHEMA = "pickup_datetime string, dropoff_datetime string, trip_distance double, fare_amount double, expected string"


def at(text):
    return dt.datetime.fromisoformat(text)


@pytest.fixture(scope="module")
def cases(spark):
    start = at("2024-01-01 00:00:00")
    trips = [
        (str(start), str(start + dt.timedelta(minutes=m)), None if d is None else float(d), None if f is None else float(f), e)
        for d, m, f, e in CASES
    ]
    trips += [
        (None, "2024-01-01 00:30:00", 1.0, 20.0, "missing_timestamp"),
        ("2024-01-01 00:30:00", None, 1.0, 20.0, "missing_timestamp"),
        ("2019-12-31 23:59:59", "2020-01-01 00:30:00", 1.0, 20.0, "outside_period"),
        ("2020-01-01 00:00:00", "2020-01-01 00:30:00", 1.0, 20.0, "accepted"),
        ("2024-12-31 23:59:59", "2025-01-01 00:30:00", 1.0, 20.0, "accepted"),
        ("2025-01-01 00:00:00", "2025-01-01 00:30:00", 1.0, 20.0, "outside_period"),
    ]
    return spark.createDataFrame(trips, SCHEMA)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("clock", ["session_tz", "wall"])
def test_first_failure_and_inclusive_bounds(cases, kind, clock):
    trips = cases.withColumns({c: F.col(c).cast(kind) for c in ("pickup_datetime", "dropoff_datetime")})
    tagged = quality.tag(trips, clock=clock)
    wrong = tagged.filter(~F.col("quality_reason").eqNullSafe(F.col("expected")))
    assert wrong.collect() == []
    kept = quality.accepted(tagged)
    assert kept.count() == 2 + sum(c[3] == "accepted" for c in CASES) and "quality_reason" not in kept.columns
    assert quality.reason_counts(tagged).agg(F.sum("trip_count")).first()[0] == len(CASES) + 6


def test_period_is_judged_in_the_session_zone(spark, utc):
    trips = spark.sql(
        "SELECT timestamp'2024-12-31 23:30:00 America/New_York' AS pickup_datetime, "
        "timestamp'2024-12-31 23:50:00 America/New_York' AS dropoff_datetime, "
        "1.0D AS trip_distance, 9.0D AS fare_amount"
    )
    assert quality.tag(trips).first().quality_reason == "outside_period"
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    assert quality.tag(trips).first().quality_reason == "accepted"


def test_clock_change_counts_real_time_only_in_the_zone(spark):
    trips = spark.sql(
        "SELECT timestamp_ntz'2024-03-10 01:00:00' AS pickup_datetime, timestamp_ntz'2024-03-10 04:00:00' AS dropoff_datetime"
    )
    assert quality.with_duration(trips, "session_tz").first().duration_minutes == 120
    assert quality.with_duration(trips, "wall").first().duration_minutes == 180
    with pytest.raises(ValueError, match="unknown clock"):
        quality.with_duration(trips, "sundial")


def test_ends_are_floored_to_seconds(spark):
    trips = spark.sql(
        "SELECT timestamp'2024-01-01 00:00:00.900' AS pickup_datetime, timestamp'2024-01-01 00:01:00.100' AS dropoff_datetime"
    )
    for clock in ("session_tz", "wall"):
        assert quality.with_duration(trips, clock).first().duration_minutes == 1.0


def test_unchecked_zones_are_accepted(spark):
    trips = spark.sql(
        "SELECT timestamp'2024-01-01 00:00:00' AS pickup_datetime, timestamp'2024-01-01 00:10:00' AS dropoff_datetime, "
        "1.0D AS trip_distance, 9.0D AS fare_amount, CAST(NULL AS INT) AS PULocationID, 9999 AS DOLocationID"
    )
    assert quality.tag(trips).first().quality_reason == "accepted"


def test_report_keeps_rule_order_and_zero_rows(spark):
    counts = spark.createDataFrame(
        [("a", "accepted", 5), ("a", "fare_over_limit", 2), ("b", "outside_period", 1)],
        "fleet string, quality_reason string, trip_count bigint",
    )
    report = [tuple(r) for r in quality.quality_report(counts, ["fleet"]).collect()]
    assert [r[2] for r in report[:11]] == ["source total", *REASONS, "accepted"]
    by_reason = {(r[0], r[2]): r[3] for r in report}
    assert by_reason["a", "source total"] == 7 and by_reason["a", "accepted"] == 5
    assert by_reason["b", "accepted"] == 0 and by_reason["b", "outside_period"] == 1
    assert len(report) == 22
    assert {r.trip_count for r in quality.quality_report(counts.filter("false")).collect()} == {0}


def test_observed_counts_equal_grouped_counts(spark, sf):
    tagged = quality.tag(adapters.event_trips(spark, sf), adapters.EVENT_LIMITS, "wall").withColumnRenamed("event_type", "fleet")
    fleets = [r[0] for r in tagged.select("fleet").distinct().collect()]
    watched, observation = quality.observe_outcomes(tagged, fleets)
    quality.accepted(watched).write.format("noop").mode("overwrite").save()
    seen = quality.observed_counts(spark, observation).filter("trip_count > 0")
    assert rows(seen, "fleet", "quality_reason", "trip_count") == rows(
        quality.reason_counts(tagged, ["fleet"]), "fleet", "quality_reason", "trip_count"
    )


def test_rows_outside_the_observed_groups_are_an_error(spark, sf):
    tagged = quality.tag(adapters.event_trips(spark, sf), adapters.EVENT_LIMITS, "wall").withColumnRenamed("event_type", "fleet")
    watched, observation = quality.observe_outcomes(tagged, ["click"])
    watched.write.format("noop").mode("overwrite").save()
    with pytest.raises(ValueError, match="classified"):
        quality.observed_counts(spark, observation)


def test_example_is_the_first_row_at_the_distance(spark, cases):
    trips = cases.withColumns({c: F.col(c).cast("timestamp") for c in ("pickup_datetime", "dropoff_datetime")})
    row = quality.example_at_distance(quality.tag(trips), FARTHEST + STEP).collect()
    assert [r.quality_reason for r in row] == ["distance_over_limit"]
    assert quality.example_at_distance(quality.tag(trips), 6860.8).collect() == []


def test_thresholds_table(spark):
    table = dict(rows(quality.thresholds(spark, Limits(max_fare=12.0))))
    assert table["max_fare_dollars"] == 12.0 and table["first_year"] == 2020.0 and len(table) == 7


def expected_reason(start, end, miles, fare):
    """The rules once more, in plain Python."""
    if start is None or end is None:
        return "missing_timestamp"
    if not 2020 <= start.year <= 2024:
        return "outside_period"
    if miles is None or math.isnan(miles) or miles <= 0:
        return "distance_missing_or_nonpositive"
    if miles > 100:
        return "distance_over_limit"
    minutes = (end - start).total_seconds() / 60
    if minutes < 1:
        return "duration_too_short"
    if minutes > 360:
        return "duration_too_long"
    if miles * 60 / minutes > 80:
        return "speed_over_limit"
    if fare is None or math.isnan(fare) or fare <= 0:
        return "fare_missing_or_nonpositive"
    return "fare_over_limit" if fare > 500 else "accepted"


def test_random_trips_against_plain_python(spark):
    rng = random.Random(11)
    edges = [None, NAN, INF, -INF, -1.0, 0.0, 0.5, 1.0, 40.0, 80.0, 100.0, 100.1, 500.0, 500.01]
    minutes = [-5, 0, 0.5, 1, 30, 60, 360, 360.5]
    trips = []
    for i in range(3000):
        start = dt.datetime(rng.choice([2019, 2020, 2022, 2024, 2025]), rng.randint(1, 12), 1, rng.randint(0, 23))
        end = start + dt.timedelta(minutes=rng.choice(minutes))
        start, end = (None if rng.random() < 0.05 else t for t in (start, end))
        trips.append((i, start, end, rng.choice(edges), rng.choice(edges)))
    schema = "i int, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, trip_distance double, fare_amount double"
    tagged = quality.tag(spark.createDataFrame(trips, schema), clock="wall")
    want = {i: expected_reason(*trip) for i, *trip in trips}
    assert {r.i: r.quality_reason for r in tagged.collect()} == want
    assert set(want.values()) == set(quality.OUTCOMES)
