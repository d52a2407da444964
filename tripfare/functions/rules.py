"""The ordered plausibility rules and the first-failure label."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

from tripfare.config import Limits

ACCEPTED = "accepted"

# Reasons in the order in which the rules are tried.
REASONS = (
    "missing_timestamp",
    "outside_period",
    "distance_missing_or_nonpositive",
    "distance_over_limit",
    "duration_too_short",
    "duration_too_long",
    "speed_over_limit",
    "fare_missing_or_nonpositive",
    "fare_over_limit",
)


def _unusable(amount: Column) -> Column:
    """NULL, NaN, zero or negative."""
    number = F.nanvl(amount, F.lit(None).cast("double"))
    return F.coalesce(number, F.lit(0.0)) <= 0


def failure_conditions(limits: Limits) -> dict[str, Column]:
    """Reason → condition under which a trip fails, over the tagged-trip columns."""
    pickup, dropoff = F.col("pickup_datetime"), F.col("dropoff_datetime")
    miles, minutes, fare = F.col("trip_distance"), F.col("duration_minutes"), F.col("fare_amount")
    # Whole years as a range: no calendar arithmetic per row.
    opens, closes = dt.date(limits.years[0], 1, 1), dt.date(limits.years[1] + 1, 1, 1)
    conditions = (
        F.isnull(pickup) | F.isnull(dropoff),
        (pickup < F.lit(opens)) | (pickup >= F.lit(closes)),
        _unusable(miles),
        miles > limits.max_miles,
        minutes < limits.minutes[0],
        minutes > limits.minutes[1],
        F.try_divide(miles * 60, minutes) > limits.max_mph,
        _unusable(fare),
        fare > limits.max_fare,
    )
    return dict(zip(REASONS, conditions, strict=True))


def first_failure(limits: Limits) -> Column:
    """Reason of the first rule that fails; ``accepted`` when none does."""
    labels = [F.when(fails, F.lit(reason)) for reason, fails in failure_conditions(limits).items()]
    return F.coalesce(*labels, F.lit(ACCEPTED))
