"""Calendar, tariff and distance features of accepted trips, and the time split."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from tripfare.config import SPLITS, Calendar
from tripfare.functions.bands import distance_band
from tripfare.functions.clock import on_or_after


def enrich(trips: DataFrame, calendar: Calendar = Calendar()) -> DataFrame:
    pickup = F.col("pickup_datetime")
    return trips.withColumns(
        {
            "pickup_hour": F.hour(pickup),
            "pickup_weekday": F.dayofweek(pickup),  # 1 = Sunday
            "pickup_month": F.month(pickup),
            "new_fare_regime": on_or_after(pickup, calendar.new_fares_from).cast("double"),
            "distance_band": distance_band(F.col("trip_distance")),
        }
    )


def split_name(calendar: Calendar) -> Column:
    """train | validation | test by pickup; NULL without a pickup."""
    pickup = F.col("pickup_datetime")
    before, later = F.lit(calendar.train_before), F.lit(calendar.test_from)
    train, validation, test = SPLITS
    return (
        F.when(pickup < before, F.lit(train))
        .when(pickup < later, F.lit(validation))
        .when(pickup >= later, F.lit(test))
    )


def with_split(trips: DataFrame, calendar: Calendar = Calendar()) -> DataFrame:
    return trips.withColumn("split", split_name(calendar))


def split_frames(trips: DataFrame, calendar: Calendar = Calendar()) -> dict[str, DataFrame]:
    """One frame per split, cut by plain ranges that reach the Parquet scan.

    A stored layer partitioned by ``pickup_year`` is pruned as well.
    """
    before, later = calendar.train_before, calendar.test_from
    ranges = dict(zip(SPLITS, ((None, before), (before, later), (later, None))))
    return {name: _between(trips, *ends) for name, ends in ranges.items()}


def _between(trips: DataFrame, start: dt.date | None, end: dt.date | None) -> DataFrame:
    pickup = F.col("pickup_datetime")
    pruned = "pickup_year" in trips.columns
    if start is not None:
        trips = trips.filter(pickup >= F.lit(start))
        if pruned:
            trips = trips.filter(F.col("pickup_year") >= start.year)
    if end is not None:
        trips = trips.filter(pickup < F.lit(end))
        if pruned:
            trips = trips.filter(F.col("pickup_year") <= end.year)
    return trips


def split_counts(trips: DataFrame, calendar: Calendar = Calendar()) -> DataFrame:
    """Rows per split, all three in one pass."""
    return (
        with_split(trips, calendar)
        .filter(F.col("split").isNotNull())
        .groupBy("split")
        .agg(F.count(F.lit(1)).alias("trip_count"))
    )


def require_split_rows(counts: DataFrame, minimum: int = 20) -> dict[str, int]:
    """The three counts as a dict; an error when a split is too small to model."""
    rows = {name: 0 for name in SPLITS} | {r["split"]: r["trip_count"] for r in counts.collect()}
    if min(rows.values()) < minimum:
        raise ValueError(f"every split needs {minimum} rows or more, got {rows}")
    return rows
