"""Per-route medians learned from training trips and joined back with a fallback."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tripfare.config import ROUTE
from tripfare.operators.durable import durable
from tripfare.operators.joins import BROADCAST_BYTES, lookup_join
from tripfare.operators.quantiles import grouped_medians

MEDIANS = {"historical_distance": "trip_distance", "historical_duration": "duration_minutes"}


@dataclass(frozen=True)
class RouteHistory:
    """A fitted lookup, its row count, and the two overall medians."""

    lookup: DataFrame
    routes: int
    fallback: Mapping[str, float]
    keys: tuple[str, ...] = ROUTE

    def fallback_frame(self) -> DataFrame:
        schema = ", ".join(f"{name} double" for name in self.fallback)
        return self.lookup.sparkSession.createDataFrame([tuple(self.fallback.values())], schema)

    def save(self, path: str) -> None:
        self.lookup.write.mode("overwrite").parquet(f"{path}/routes")
        self.fallback_frame().write.mode("overwrite").json(f"{path}/fallback")


def load_history(spark: SparkSession, path: str) -> RouteHistory:
    lookup = spark.read.parquet(f"{path}/routes")
    schema = ", ".join(f"{name} double" for name in MEDIANS)
    fallback = spark.read.schema(schema).json(f"{path}/fallback").first().asDict()
    return RouteHistory(lookup, lookup.count(), fallback, tuple(c for c in lookup.columns if c not in MEDIANS))


def route_medians(training: DataFrame, keys: Sequence[str] = ROUTE) -> DataFrame:
    return grouped_medians(training, keys, MEDIANS)


def fallback_medians(training: DataFrame) -> DataFrame:
    return grouped_medians(training, (), MEDIANS)


def fit_history(training: DataFrame, keys: Sequence[str] = ROUTE) -> RouteHistory:
    """Fit on training trips only.

    The lookup is stored, so its size is known from here on.
    """
    values = durable(training.select(*keys, *MEDIANS.values()), "training-values")
    lookup = durable(grouped_medians(values, keys, MEDIANS), "routes")
    overall = grouped_medians(values, (), MEDIANS).first()
    fallback = overall.asDict() if overall else dict.fromkeys(MEDIANS)
    return RouteHistory(lookup, lookup.count(), fallback, tuple(keys))


def apply_history(trips: DataFrame, history: RouteHistory, broadcast_limit: int = BROADCAST_BYTES) -> DataFrame:
    """Add both medians and ``unseen_pair``; routes not in the lookup take the fallback.

    A NULL zone matches no route.
    """
    joined = lookup_join(
        trips, history.lookup, history.keys, lookup_rows=history.routes, broadcast_limit=broadcast_limit
    )
    filled = {n: F.coalesce(F.nanvl(n, F.lit(None).cast("double")), F.lit(v).cast("double")) for n, v in history.fallback.items()}
    return joined.withColumn("unseen_pair", F.col("historical_distance").isNull()).withColumns(filled)


def unseen_count(trips: DataFrame) -> DataFrame:
    return trips.agg(F.count_if("unseen_pair").alias("unseen_rows"))
