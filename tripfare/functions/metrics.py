"""Regression metrics as aggregate expressions, so one pass gives all of them."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Name and tolerance (dollars, inclusive) of the hit-rate metrics.
TOLERANCES = (("within_2_pct", 2), ("within_5_pct", 5))

METRICS = ("mae", "rmse", "r2", "within_2_pct", "within_5_pct")


def absolute_error(actual: Column, predicted: Column) -> Column:
    return F.abs(predicted - actual)


def metric_aggregates(actual: Column, predicted: Column) -> list[Column]:
    miss = absolute_error(actual, predicted)
    mean_square = F.avg(miss * miss)
    spread = F.var_pop(actual)
    hit_rates = [
        (F.lit(100) * F.avg((miss <= dollars).cast("double"))).alias(name) for name, dollars in TOLERANCES
    ]
    return [
        F.count(F.lit(1)).alias("n"),
        F.avg(miss).alias("mae"),
        F.sqrt(mean_square).alias("rmse"),
        # try_divide: no spread means no R2, not an error.
        (F.lit(1) - F.try_divide(mean_square, spread)).alias("r2"),
        *hit_rates,
    ]
