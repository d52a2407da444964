"""The four demand and fare reports over accepted, enriched trips.

Each report is a roll-up of *cells*: trips counted over the few columns it
needs. Two sets of cells serve all four reports. One is over time, the other
over place, and they share no stored column, so together they read each column
of the trips once.
"""

from __future__ import annotations

import uuid
from typing import Sequence

from pyspark.sql import DataFrame, functions as F

from tripfare.config import StudyConfig
from tripfare.functions import money
from tripfare.functions.clock import month_label
from tripfare.operators.durable import durable

_YEAR, _MONTH, _HOUR, _BAND, _ZONE = "pickup_year", "pickup_month", "pickup_hour", "distance_band", "DOLocationID"


def cells(trips: DataFrame, dims: Sequence[str], by: Sequence[str] = (), fares: bool = False) -> DataFrame:
    """Trips per combination of ``dims``; ``fares`` adds exact fare sums and the shortest distance.

    Combined before the shuffle; a busy cell costs one row per task.
    """
    if _YEAR in dims and _YEAR not in trips.columns:
        trips = trips.withColumn(_YEAR, F.year("pickup_datetime"))
    sums = [*money.exact_sums(F.col("fare_amount"), "fare"), F.min("trip_distance").alias("nearest")] if fares else []
    return trips.groupBy(*by, *dims).agg(F.count(F.lit(1)).alias("trip_count"), *sums)


def time_cells(trips: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return cells(trips, (_YEAR, _MONTH, _HOUR), by)


def place_cells(trips: DataFrame, by: Sequence[str] = (), mapped_zones: tuple[int, int] = StudyConfig.mapped_zones) -> DataFrame:
    """Unmapped zones are folded into one, which bounds the cells."""
    zone = F.when(F.col(_ZONE).between(*mapped_zones), F.col(_ZONE))
    return cells(trips.withColumn(_ZONE, zone), (_BAND, _ZONE), by, fares=True)


def _count() -> list:
    return [F.sum("trip_count").alias("trip_count")]


def _count_and_fares() -> list:
    return [*_count(), *money.summed("fare")]


def monthly_from(counted: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    months = counted.groupBy(*by, _YEAR, _MONTH).agg(*_count())
    label = month_label(F.col(_YEAR), F.col(_MONTH)).alias("month")
    return months.select(*by, label, "trip_count").orderBy(*by, "month")


def hourly_from(counted: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return counted.groupBy(*by, _HOUR).agg(*_count()).orderBy(*by, _HOUR)


def by_distance_from(counted: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Ordered by the shortest distance seen in each band."""
    bands = counted.groupBy(*by, _BAND).agg(*_count_and_fares(), F.min("nearest").alias("nearest"))
    mean = money.mean("fare", "trip_count").alias("mean_fare")
    return bands.orderBy(*by, "nearest").select(*by, _BAND, "trip_count", mean)


def dropoffs_from(
    counted: DataFrame,
    minimum: int = StudyConfig.minimum_trips,
    mapped_zones: tuple[int, int] = StudyConfig.mapped_zones,
    top: int = 5,
) -> DataFrame:
    """Destinations with the highest mean fare among those with enough trips.

    Ranked by the exact mean, so zones of equal mean are in order of their ids.
    """
    return (
        counted.filter(F.col(_ZONE).between(*mapped_zones))
        .groupBy(_ZONE)
        .agg(*_count_and_fares())
        .filter(F.col("trip_count") >= minimum)
        .orderBy(money.exact_mean("fare", "trip_count").desc(), _ZONE)
        .limit(top)
        .select(_ZONE, "trip_count", money.mean("fare", "trip_count").alias("mean_fare"))
    )


def monthly_trips(trips: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return monthly_from(cells(trips, (_YEAR, _MONTH), by), by)


def register_trips(trips: DataFrame, name: str | None = None) -> str:
    """Offer the trips to SQL; a fresh name per call keeps concurrent studies apart."""
    view = name or f"trips_{uuid.uuid4().hex}"
    trips.createOrReplaceTempView(view)
    return view


def hourly_trips(trips: DataFrame) -> DataFrame:
    """Trips per pickup hour, as SQL over the registered view."""
    view = register_trips(trips)
    return trips.sparkSession.sql(
        f"SELECT pickup_hour, count(*) AS trip_count FROM {view} GROUP BY ALL ORDER BY pickup_hour"
    )


def fare_by_distance(trips: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return by_distance_from(cells(trips, (_BAND,), by, fares=True), by)


def highest_fare_dropoffs(
    trips: DataFrame,
    minimum: int = StudyConfig.minimum_trips,
    mapped_zones: tuple[int, int] = StudyConfig.mapped_zones,
    top: int = 5,
) -> DataFrame:
    mapped = trips.filter(F.col(_ZONE).between(*mapped_zones))
    return dropoffs_from(cells(mapped, (_ZONE,), fares=True), minimum, mapped_zones, top)


def analyses(
    trips: DataFrame,
    minimum: int = StudyConfig.minimum_trips,
    mapped_zones: tuple[int, int] = StudyConfig.mapped_zones,
) -> dict[str, DataFrame]:
    """All four reports; every needed column of the trips is read once."""
    over_time = durable(time_cells(trips), "time-cells")
    over_place = durable(place_cells(trips, mapped_zones=mapped_zones), "place-cells")
    return reports_from(over_time, over_place, minimum, mapped_zones)


def reports_from(
    over_time: DataFrame,
    over_place: DataFrame,
    minimum: int = StudyConfig.minimum_trips,
    mapped_zones: tuple[int, int] = StudyConfig.mapped_zones,
) -> dict[str, DataFrame]:
    return {
        "monthly_trips": monthly_from(over_time),
        "hourly_trips": hourly_from(over_time),
        "fare_by_distance": by_distance_from(over_place),
        "highest_fare_dropoffs": dropoffs_from(over_place, minimum, mapped_zones),
    }
