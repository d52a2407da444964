"""Errors of predictions: metrics, diagnostics and comparison tables."""

from __future__ import annotations

from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tripfare.config import ROUTE, SPLITS
from tripfare.functions.bands import fare_band
from tripfare.functions.metrics import METRICS, absolute_error, metric_aggregates


def training_mean(training: DataFrame) -> DataFrame:
    return training.agg(F.avg("fare_amount").alias("mean_fare"))


def regime_counts(training: DataFrame) -> DataFrame:
    counts = training.groupBy("new_fare_regime").agg(F.count(F.lit(1)).alias("trip_count"))
    return counts.orderBy("new_fare_regime")


def with_constant(trips: DataFrame, constant: DataFrame) -> DataFrame:
    """Predict one value for all trips; ``constant`` has one row and one column."""
    return trips.withColumn("prediction", constant.scalar())


def regression_metrics(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """All metrics in one pass; NULL metrics for no rows, NULL R2 for no spread."""
    return predictions.groupBy(*by).agg(*metric_aggregates(F.col("fare_amount"), F.col("prediction")))


def with_error(predictions: DataFrame) -> DataFrame:
    return predictions.withColumn("absolute_error", absolute_error(F.col("fare_amount"), F.col("prediction")))


def error_by_fare_band(predictions: DataFrame) -> DataFrame:
    error = F.col("absolute_error")
    return (
        with_error(predictions)
        .groupBy(fare_band(F.col("fare_amount")).alias("fare_band"))
        .agg(
            F.count(F.lit(1)).alias("trip_count"),
            F.avg(error).alias("mae"),
            F.sqrt(F.avg(error * error)).alias("rmse"),
        )
        .orderBy("fare_band")
    )


def worst_residuals(predictions: DataFrame, rows: int = 20, tie_break: Sequence[str] = ()) -> DataFrame:
    """The largest misses; ``tie_break`` columns make the cut unambiguous."""
    shown = ("pickup_datetime", *ROUTE, "trip_distance", "duration_minutes", "fare_amount", "prediction", "absolute_error")
    return (
        with_error(predictions)
        .orderBy(F.desc("absolute_error"), "pickup_datetime", *ROUTE, *tie_break)
        .limit(rows)
        .select(*tie_break, *shown)
    )


def candidate_predictions(scored: Mapping[tuple[str, str], DataFrame], by: Sequence[str] = ()) -> DataFrame:
    """Fares and predictions of every (case, model), one under the other."""
    parts = [
        frame.select(
            *by,
            F.lit(position).alias("position"),
            F.lit(case).alias("setting"),
            F.lit(model).alias("model"),
            "fare_amount",
            "prediction",
        )
        for position, ((case, model), frame) in enumerate(scored.items())
    ]
    return reduce(DataFrame.unionByName, parts)


def rank_predictions(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One metric row per candidate, all scored in one aggregation."""
    keys = (*by, "position", "setting", "model")
    return regression_metrics(predictions, keys).select(*keys, "n", *METRICS)


def compare_models(scored: Mapping[tuple[str, str], DataFrame], by: Sequence[str] = ()) -> DataFrame:
    """One metric row per (case, model), scored together in one aggregation."""
    return rank_predictions(candidate_predictions(scored, by), by)


def rmse_change(metrics: DataFrame, better: str, base: str, by: Sequence[str] = ()) -> DataFrame:
    """How far, in percent, the RMSE of one setting lies below that of another."""
    pick = {s: F.max(F.when(F.col("setting") == s, F.col("rmse"))) for s in (better, base)}
    return metrics.groupBy(*by).agg(
        pick[base].alias("base_rmse"),
        pick[better].alias("rmse"),
        ((1 - F.try_divide(pick[better], pick[base])) * 100).alias("below_pct"),
    )


def summary_from(accepted: DataFrame, splits: DataFrame, fraction: Column, by: Sequence[str]) -> DataFrame:
    """Accepted rows, sample fraction and sampled rows per split.

    ``accepted`` has ``accepted_rows`` and ``splits`` has ``split`` and
    ``trip_count``, both per group: a handful of rows.
    """
    per_split = [F.coalesce(F.sum(F.when(F.col("split") == s, F.col("trip_count"))), F.lit(0)).alias(f"{s}_rows") for s in SPLITS]
    counts = [F.coalesce(F.col(f"{s}_rows"), F.lit(0)).alias(f"{s}_rows") for s in SPLITS]
    joined = accepted.join(splits.groupBy(*by).agg(*per_split), list(by), "left")
    return joined.select(*by, "accepted_rows", fraction.alias("sample_fraction"), *counts)


def run_summary(trips: DataFrame, sampled: DataFrame, fraction: float, by: Sequence[str]) -> DataFrame:
    """``summary_from`` the trips themselves; ``sampled`` carries ``split``."""
    accepted = trips.groupBy(*by).agg(F.count(F.lit(1)).alias("accepted_rows"))
    splits = sampled.groupBy(*by, "split").agg(F.count(F.lit(1)).alias("trip_count"))
    return summary_from(accepted, splits, F.lit(float(fraction)), by)


def route_coverage(history: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Test rows on unseen routes, and training rows per tariff regime; absent ones count 0."""
    train, test = F.col("split") == "train", F.col("split") == "test"
    regime = F.col("new_fare_regime")
    return history.groupBy(*by).agg(
        F.count_if(test & F.col("unseen_pair")).alias("unseen_test_rows"),
        F.count_if(train & (regime == 0)).alias("old_regime_train_rows"),
        F.count_if(train & (regime == 1)).alias("new_regime_train_rows"),
    )
