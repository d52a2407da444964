"""Tag every trip, split off the accepted ones, account for the rest."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tripfare.config import Limits
from tripfare.functions.clock import elapsed_minutes
from tripfare.functions.rules import ACCEPTED, REASONS, first_failure

OUTCOMES = (*REASONS, ACCEPTED)


def with_duration(trips: DataFrame, clock: str = "session_tz") -> DataFrame:
    return trips.withColumn(
        "duration_minutes", elapsed_minutes(F.col("pickup_datetime"), F.col("dropoff_datetime"), clock)
    )


def tag(trips: DataFrame, limits: Limits = Limits(), clock: str = "session_tz") -> DataFrame:
    """Add ``duration_minutes`` and ``quality_reason``."""
    return with_duration(trips, clock).withColumn("quality_reason", first_failure(limits))


def accepted(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col("quality_reason") == ACCEPTED).drop("quality_reason")


def reason_counts(tagged: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return tagged.groupBy(*by, "quality_reason").agg(F.count(F.lit(1)).alias("trip_count"))


def quality_totals(tagged: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Source and accepted row totals."""
    totals = (
        F.count(F.lit(1)).alias("source_rows"),
        F.count_if(F.col("quality_reason") == ACCEPTED).alias("accepted_rows"),
    )
    return tagged.groupBy(*by).agg(*totals)


def thresholds(spark: SparkSession, limits: Limits) -> DataFrame:
    return spark.createDataFrame(limits.as_rows(), "threshold string, value double")


def quality_report(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The source total, then every outcome in rule order, zero-filled.

    ``counts`` holds at most one row per outcome and ``by`` value, so the
    fixed outcome list is laid out next to it without another look at the trips.
    """
    per_outcome = [
        F.coalesce(F.sum(F.when(F.col("quality_reason") == o, F.col("trip_count"))), F.lit(0)).alias(o)
        for o in OUTCOMES
    ]
    wide = counts.groupBy(*by).agg(F.sum("trip_count").alias("source total"), *per_outcome)
    rows = F.array(
        *[
            F.struct(F.lit(i).alias("position"), F.lit(name).alias("reason"), F.coalesce(F.col(f"`{name}`"), F.lit(0)).alias("trip_count"))
            for i, name in enumerate(("source total", *OUTCOMES))
        ]
    )
    return wide.select(*by, F.inline(rows)).orderBy(*by, "position")


def example_at_distance(tagged: DataFrame, distance: float, rows: int = 1) -> DataFrame:
    """The first trips, by pickup, that report exactly ``distance``."""
    columns = ("pickup_datetime", "trip_distance", "duration_minutes", "fare_amount", "quality_reason")
    return (
        tagged.filter(F.col("trip_distance") == distance)
        .select(*columns)
        .orderBy("pickup_datetime", "duration_minutes", "fare_amount", "quality_reason")
        .limit(rows)
    )


EXAMPLE = "pickup_datetime timestamp, trip_distance double, duration_minutes double, fare_amount double, quality_reason string"


def observe_outcomes(
    tagged: DataFrame, groups: Sequence[str], column: str = "fleet", example_distance: float | None = None
) -> tuple[DataFrame, Observation]:
    """Count outcomes per group while the rows flow to another action.

    ``groups`` is a short, fixed list of values of ``column``, such as the fleets.
    With ``example_distance`` the first trip of each group that reports exactly
    this distance is noted as well.
    """
    observation = Observation()
    if example_distance is not None:
        order = ("pickup_datetime", "duration_minutes", "fare_amount", "quality_reason")
        at = F.struct(F.col("pickup_datetime").cast("timestamp").alias("pickup_datetime"), *order[1:], "trip_distance")
        examples = [
            F.min(F.when((F.col(column) == g) & (F.col("trip_distance") == example_distance), at)).alias(f"{g}|example") for g in groups
        ]
    else:
        examples = []
    counters = [
        F.count_if((F.col(column) == g) & (F.col("quality_reason") == o)).alias(f"{g}|{o}")
        for g in groups
        for o in OUTCOMES
    ]
    return tagged.observe(observation, F.count(F.lit(1)).alias("all"), *counters, *examples), observation


def observed_examples(spark: SparkSession, observation: Observation, column: str = "fleet") -> DataFrame:
    """The noted trips, one row per group that has one."""
    found = {name.rsplit("|", 1)[0]: row for name, row in observation.get.items() if name.endswith("|example") and row is not None}
    names = [f.split()[0] for f in EXAMPLE.split(", ")]
    return spark.createDataFrame([(g, *[row[n] for n in names]) for g, row in found.items()], f"{column} string, {EXAMPLE}")


def observed_counts(spark: SparkSession, observation: Observation, column: str = "fleet") -> DataFrame:
    """The observed counters as a ``reason_counts`` table; checks that no row escaped them."""
    values = {name: n for name, n in observation.get.items() if not name.endswith("|example")}
    total = values.pop("all")
    if sum(values.values()) != total:
        raise ValueError(f"{total} rows were written but {sum(values.values())} were classified")
    rows = [(*name.split("|", 1), count) for name, count in values.items()]
    return spark.createDataFrame(rows, f"{column} string, quality_reason string, trip_count bigint")
