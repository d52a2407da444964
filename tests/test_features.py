import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tripfare.config import Calendar, StudyConfig
from tripfare.functions import bands
from tripfare.operators import features, sampling
from tripfare.sources import adapters


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_tariff_changes_at_local_midnight(spark, kind):
    trips = spark.createDataFrame(
        [("2022-12-18 23:59:59", 1.0), ("2022-12-19 00:00:00", 1.0)], "pickup_datetime string, trip_distance double"
    ).withColumn("pickup_datetime", F.col("pickup_datetime").cast(kind))
    flags = features.enrich(trips).orderBy("pickup_datetime")
    assert [r.new_fare_regime for r in flags.collect()] == [0.0, 1.0]


def test_calendar_uses_the_session_zone(spark):
    trips = spark.sql("SELECT timestamp'2024-01-01 03:30:00 UTC' AS pickup_datetime, 1.0D AS trip_distance")
    row = features.enrich(trips).first()  # Sunday 2023-12-31 22:30 in New York
    assert (row.pickup_hour, row.pickup_weekday, row.pickup_month) == (22, 1, 12)


def test_bands_are_closed_on_the_left(spark):
    values = [0.5, 1.0, 1.99, 2.0, 5.0, 10.0, 20.0, 99.0, None, float("nan")]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    miles = [r[0] for r in frame.orderBy("i").select(bands.distance_band(F.col("v"))).collect()]
    assert miles == ["0–1", "1–2", "1–2", "2–5", "5–10", "10–20", "20–100", "20–100", "20–100", "20–100"]
    fares = [r[0] for r in frame.withColumn("v", F.col("v") * 10).orderBy("i").select(bands.fare_band(F.col("v"))).collect()]
    assert fares == ["under_20", "under_20", "under_20", "20_to_50"] + ["50_plus"] * 6


def test_splits_partition_the_trips(spark):
    days = ["2022-12-31 23:59:59", "2023-01-01 00:00:00", "2023-12-31 23:59:59", "2024-01-01 00:00:00"]
    trips = spark.createDataFrame([(d,) for d in days], "pickup_datetime string").select(F.col("pickup_datetime").cast("timestamp"))
    named = [r.split for r in features.with_split(trips).orderBy("pickup_datetime").collect()]
    assert named == ["train", "validation", "validation", "test"]
    frames = features.split_frames(trips)
    assert {name: f.count() for name, f in frames.items()} == {"train": 1, "validation": 2, "test": 1}
    assert dict(rows(features.split_counts(trips))) == {"train": 1, "validation": 2, "test": 1}


def test_split_ranges_reach_the_scan(spark, sf):
    events = adapters.table(spark, sf, "events").withColumnRenamed("ts", "pickup_datetime")
    part = features.split_frames(events, adapters.EVENT_CALENDAR)["validation"].select("event_id")
    plan = part._jdf.queryExecution().executedPlan().toString()
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    assert "GreaterThanOrEqual(pickup_datetime" in pushed.replace("ts", "pickup_datetime") or "GreaterThanOrEqual(ts" in pushed


def test_small_splits_are_refused(spark):
    counts = spark.createDataFrame([("train", 50), ("test", 19)], "split string, trip_count bigint")
    with pytest.raises(ValueError, match="every split needs 20"):
        features.require_split_rows(counts)
    with pytest.raises(ValueError, match="'validation': 0"):
        features.require_split_rows(counts, 1)


def test_hash_sample_ignores_the_layout(spark):
    trips = spark.range(5000).withColumnRenamed("id", "k")
    one = rows(sampling.hash_sample(trips.coalesce(1), ["k"], 0.2))
    many = rows(sampling.hash_sample(trips.repartition(7), ["k"], 0.2))
    assert one == many and 850 < len(one) < 1150
    assert rows(sampling.hash_sample(trips, ["k"], 1.0)) == rows(trips)
    assert rows(sampling.hash_sample(trips, ["k"], 0.2, seed=1)) != one


def test_sample_arguments(spark):
    trips = spark.range(10).withColumn("d", F.lit(1.0))
    for fraction in (0, 1.5, -0.1):
        with pytest.raises(ValueError):
            sampling.bernoulli_sample(trips, fraction)
        with pytest.raises(ValueError):
            StudyConfig(fractions={"yellow": fraction})
    with pytest.raises(TypeError):
        sampling.hash_sample(trips, ["d"], 0.5)
    assert rows(sampling.bernoulli_sample(trips, 0.5)) == rows(sampling.bernoulli_sample(trips, 0.5))


def test_next_event_crosses_hours_like_one_window(spark, sf):
    trips = adapters.event_trips(spark, sf)
    adapters.table(spark, sf, "events").createOrReplaceTempView("raw_events")
    plain = spark.sql("SELECT event_id, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS dropoff_datetime FROM raw_events")
    assert rows(trips, "event_id", "dropoff_datetime") == rows(plain, "event_id", "dropoff_datetime")


def test_calendar_defaults():
    assert Calendar().test_from == dt.date(2024, 1, 1)
