"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local task slots.
"""

from __future__ import annotations

import json
import os
import time
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks import queries as q
from tripfare.config import StudyConfig
from tripfare.operators import analysis, features
from tripfare.operators.durable import shared_folder
from tripfare.plans.study import clean_and_store, model_study
from tripfare.sources import adapters

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = (
    "quality_counts",
    "quality_counts_events",
    "monthly_trips",
    "hourly_trips",
    "fare_by_distance",
    "highest_fare_dropoffs",
    "shared_scan_reports",
    "hash_sample",
    "temporal_split_counts",
    "route_medians",
    "route_history",
    "baseline_metrics",
    "route_rate_metrics",
    "worst_residuals",
    "linear_regression",
)
ORDERS = StudyConfig(
    limits=adapters.ORDER_LIMITS,
    calendar=adapters.ORDER_CALENDAR,
    clock="wall",
    fractions={"orders": 1.0},
    minimum_trips=5,
    mapped_zones=adapters.ORDER_ZONES,
)
EVENTS = StudyConfig(
    limits=adapters.EVENT_LIMITS,
    calendar=adapters.EVENT_CALENDAR,
    clock="wall",
    fractions={"events": 1.0},
    minimum_trips=5,
)


def drain(table: DataFrame) -> None:
    """Compute every row without storing it."""
    table.write.format("noop").mode("overwrite").save()


def timed(action) -> tuple[float, object]:
    started = time.perf_counter()
    result = action()
    return time.perf_counter() - started, result


def staged(spark: SparkSession, scratch: str) -> dict[str, float]:
    """The stages of a whole study: clean and store, four reports, modelling."""
    seconds = {}
    for name, source, config in (
        ("orders", adapters.order_trips, ORDERS),
        ("events", adapters.event_trips, EVENTS),
    ):
        trips = source(spark, SF_DIR).withColumn("fleet", F.lit(name))
        seconds[f"study_{name}_clean"], (stored, *_) = timed(
            lambda: clean_and_store(trips, f"{scratch}/{name}", config, [name])
        )
        enriched = features.enrich(stored, config.calendar)
        reports = lambda: [
            drain(r) for r in analysis.analyses(enriched, config.minimum_trips, config.mapped_zones).values()
        ]
        seconds[f"study_{name}_reports"], _ = timed(reports)
        if name == "events":
            models = lambda: drain(model_study(enriched, f"{scratch}/models", config, 1.0)["model_comparison"])
            seconds[f"study_{name}_models"], _ = timed(models)
    return seconds


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "America/New_York")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    small = os.path.join(os.path.dirname(SF_DIR.rstrip("/")), "sf0.001")
    # Start-up and first compilation are not part of a query.
    for name in HEADLINE:
        drain(q.QUERIES[name](spark, small if os.path.isdir(small) else SF_DIR))
    for trips in (q.order_tagged, q.event_tagged):
        drain(trips(spark, SF_DIR))
    seconds = {name: timed(lambda: drain(q.QUERIES[name](spark, SF_DIR)))[0] for name in HEADLINE}
    seconds |= staged(spark, f"{shared_folder(spark)}/bench-{uuid.uuid4().hex}")
    rows = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").count()
    line = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": {name: round(s, 3) for name, s in seconds.items()},
        "sf": SF_DIR.rsplit("sf", 1)[-1],
        "clean_rows_per_sec": round(rows / seconds["study_orders_clean"]),
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
