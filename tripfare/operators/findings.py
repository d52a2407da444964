"""Headline numbers drawn from the four reports."""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tripfare.functions import money


def yearly_trips(monthly: DataFrame) -> DataFrame:
    year = F.substring("month", 1, 4).alias("year")
    return monthly.groupBy(year).agg(F.sum("trip_count").alias("trip_count")).orderBy("year")


def _percent_change(new: Column, old: Column) -> Column:
    return (F.try_divide(new, old) - 1) * 100


def lowest_month(monthly: DataFrame, base_month: str) -> DataFrame:
    """The quietest month (ties: the earliest) and how far below a named month it is, in percent.

    Without the named month the drop is NULL.
    """
    base = F.max(F.when(F.col("month") == base_month, F.col("trip_count")))
    low = F.min_by("month", F.struct("trip_count", "month"))
    return monthly.agg(
        F.lit(base_month).alias("base_month"),
        base.alias("base_count"),
        low.alias("month"),
        F.min("trip_count").alias("trip_count"),
        (-_percent_change(F.min("trip_count"), base)).alias("drop_pct"),
    )


def annual_change(yearly: DataFrame) -> DataFrame:
    """Change from the first to the last year, in percent."""
    first, last = F.min_by("trip_count", "year"), F.max_by("trip_count", "year")
    return yearly.agg(
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"),
        first.alias("first_count"),
        last.alias("last_count"),
        _percent_change(last, first).alias("change_pct"),
    )


def busiest_hour(hourly: DataFrame) -> DataFrame:
    """Ties go to the earliest hour."""
    return hourly.orderBy(F.desc("trip_count"), "pickup_hour").limit(1)


def band_extremes(trips: DataFrame) -> DataFrame:
    """Nearest and farthest distance band with their mean fares, from trips or cells."""
    if "fare_whole" not in trips.columns:
        whole, rest = money.whole_and_rest(F.col("fare_amount"))
        trips = trips.select(
            "distance_band",
            F.lit(1).alias("trip_count"),
            whole.alias("fare_whole"),
            rest.alias("fare_rest"),
            F.col("trip_distance").alias("nearest"),
        )
    bands = trips.groupBy("distance_band").agg(
        F.sum("trip_count").alias("trip_count"), *money.summed("fare"), F.min("nearest").alias("nearest")
    )
    bands = bands.withColumn("mean_fare", money.mean("fare", "trip_count"))
    return bands.agg(
        F.min_by("distance_band", "nearest").alias("nearest_band"),
        F.min_by("mean_fare", "nearest").alias("nearest_mean_fare"),
        F.max_by("distance_band", "nearest").alias("farthest_band"),
        F.max_by("mean_fare", "nearest").alias("farthest_mean_fare"),
    )


def top_destination(dropoffs: DataFrame) -> DataFrame:
    return dropoffs.orderBy(F.desc("mean_fare"), "DOLocationID").limit(1)


def findings(reports: Mapping[str, DataFrame], over_place: DataFrame, base_month: str) -> dict[str, DataFrame]:
    yearly = yearly_trips(reports["monthly_trips"])
    return {
        "yearly_trips": yearly,
        "lowest_month": lowest_month(reports["monthly_trips"], base_month),
        "annual_change": annual_change(yearly),
        "busiest_hour": busiest_hour(reports["hourly_trips"]),
        "band_extremes": band_extremes(over_place),
        "top_destination": top_destination(reports["highest_fare_dropoffs"]),
    }
