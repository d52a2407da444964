"""Left-closed numeric bands."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Upper edge (exclusive) and label of each distance band, in miles.
# The dash in the labels is an en dash.
DISTANCE_BANDS = (
    (1, "0–1"),
    (2, "1–2"),
    (5, "2–5"),
    (10, "5–10"),
    (20, "10–20"),
)
LAST_DISTANCE_BAND = "20–100"

# Upper edge (exclusive) and label of each fare band, in dollars.
FARE_BANDS = (
    (20, "under_20"),
    (50, "20_to_50"),
)
LAST_FARE_BAND = "50_plus"


def banded(value: Column, cuts, rest: str) -> Column:
    """Label of the first band whose upper edge exceeds ``value``; NULL and NaN give ``rest``."""
    return F.coalesce(*[F.when(value < upper, F.lit(label)) for upper, label in cuts], F.lit(rest))


def distance_band(miles: Column) -> Column:
    return banded(miles, DISTANCE_BANDS, LAST_DISTANCE_BAND)


def fare_band(fare: Column) -> Column:
    return banded(fare, FARE_BANDS, LAST_FARE_BAND)
