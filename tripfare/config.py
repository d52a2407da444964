"""Everything a run can be told, as plain frozen values."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from types import MappingProxyType
from typing import Mapping

# Timestamp column prefix per fleet, and the monthly file name.
TIMESTAMP_PREFIX = MappingProxyType({"yellow": "tpep", "green": "lpep"})
MONTHLY_FILE = "{fleet}_tripdata_{year}-{month:02d}.parquet"

ROUTE = ("PULocationID", "DOLocationID")
SPLITS = ("train", "validation", "test")


# The defaults of the three classes below and the threshold names
# must be these for results to be comparable.
@dataclass(frozen=True)
class Limits:
    """Bounds of an ordinary trip; values on a bound are accepted."""

    years: tuple[int, int] = (2020, 2024)
    max_miles: float = 100.0
    minutes: tuple[float, float] = (1.0, 360.0)
    max_mph: float = 80.0
    max_fare: float = 500.0

    def as_rows(self) -> list[tuple[str, float]]:
        return [
            ("first_year", float(self.years[0])),
            ("last_year", float(self.years[1])),
            ("max_distance_miles", self.max_miles),
            ("min_duration_minutes", self.minutes[0]),
            ("max_duration_minutes", self.minutes[1]),
            ("max_average_speed_mph", self.max_mph),
            ("max_fare_dollars", self.max_fare),
        ]


@dataclass(frozen=True)
class Calendar:
    """Dates that cut the study: two split bounds and the tariff change."""

    train_before: dt.date = dt.date(2023, 1, 1)
    test_from: dt.date = dt.date(2024, 1, 1)
    new_fares_from: dt.date = dt.date(2022, 12, 19)


@dataclass(frozen=True)
class StudyConfig:
    limits: Limits = Limits()
    calendar: Calendar = Calendar()
    # "session_tz": elapsed time in the session zone; "wall": plain clock difference.
    clock: str = "session_tz"
    fractions: Mapping[str, float] = field(
        default_factory=lambda: {"yellow": 0.002, "green": 0.05}
    )
    seed: int = 42
    minimum_trips: int = 500
    mapped_zones: tuple[int, int] = (1, 263)
    minimum_split_rows: int = 20
    example_distance: float = 6860.8
    base_month: str = "2020-01"

    def __post_init__(self):
        for fleet, fraction in self.fractions.items():
            if not 0 < fraction <= 1:
                raise ValueError(f"{fleet}: sample fraction {fraction} is outside (0, 1]")
