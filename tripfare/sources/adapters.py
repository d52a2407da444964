"""Trip tables made from the order and event tables used for testing."""

from __future__ import annotations

import datetime as dt
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tripfare.config import Calendar, Limits

ORDER_LIMITS = Limits(
    years=(1995, 2000), max_miles=45.0, minutes=(1440.0, 1_440_000.0), max_mph=0.01, max_fare=80_000.0
)
ORDER_CALENDAR = Calendar(dt.date(1999, 1, 1), dt.date(2000, 1, 1), dt.date(1998, 12, 1))
ORDER_ZONES = (1, 24)

EVENT_LIMITS = Limits(years=(2024, 2024), max_miles=20.0, minutes=(1.0, 360.0), max_mph=20.0, max_fare=150.0)
EVENT_CALENDAR = Calendar(dt.date(2024, 1, 15), dt.date(2024, 1, 22), dt.date(2024, 1, 10))


# The columns each adapter reads. Declared, so no footer is opened to infer them.
TABLES = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "customer": "c_custkey bigint, c_nationkey int",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "lineitem": (
        "l_orderkey bigint, l_linenumber int, l_suppkey bigint, l_quantity double, "
        "l_extendedprice double, l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def order_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trip per order line: ordered → shipped, customer nation → supplier nation.

    A line without its order, customer or supplier stays, with what is missing NULL.
    """
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").alias("pickup_datetime")
    )
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("PULocationID")
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("DOLocationID")
    )
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        F.col("l_shipdate").alias("dropoff_datetime"),
        F.nullif("l_quantity", F.lit(50.0)).alias("trip_distance"),
        F.col("l_extendedprice").alias("fare_amount"),
    )
    # Customers join the orders, which are fewer than the lines. Keys are spread
    # evenly: an order has a handful of lines. Spark broadcasts what is small.
    origins = orders.join(customers, "o_custkey", "left").select(
        F.col("o_orderkey").alias("l_orderkey"), "pickup_datetime", "PULocationID"
    )
    return (
        lines.join(suppliers, "l_suppkey", "left")
        .join(origins, "l_orderkey", "left")
        .select(
            "l_orderkey",
            "l_linenumber",
            "pickup_datetime",
            "dropoff_datetime",
            "trip_distance",
            "fare_amount",
            "PULocationID",
            "DOLocationID",
        )
    )


def event_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trip per event, ending at the user's next event."""
    events = table(spark, sf_dir, "events").withColumn(
        "DOLocationID", F.get_json_object("props", "$.k").try_cast("int")
    )
    return with_next(events).select(
        "event_id",
        "event_type",
        F.col("ts").alias("pickup_datetime"),
        F.col("next_ts").alias("dropoff_datetime"),
        (F.col("value") / 10).alias("trip_distance"),
        F.col("value").alias("fare_amount"),
        (F.col("user_id") % 25).cast("int").alias("PULocationID"),
        "DOLocationID",
    )


# Events without time belong to no hour; they are dealt into so many groups.
UNTIMED_GROUPS = 1024


def with_next(events: DataFrame) -> DataFrame:
    """``next_ts``: the time of the user's next event, by time and id.

    The next event is looked up inside (user, hour); the last event of an hour
    looks at the first one of the user's next busy hour. So a busy user is not a
    single task, and the events are dealt once: the windows and the join share
    their keys. Events without time have no next and are none; those without
    user are taken as one user's.
    """
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    spread = F.when(F.col("ts").isNull(), F.pmod(F.xxhash64("event_id"), F.lit(UNTIMED_GROUPS))).otherwise(0)
    # Keys without NULLs, so that equal ones meet in a plain join.
    keyed = events.withColumns(
        {
            "no_user": F.col("user_id").isNull(),
            "user": F.coalesce("user_id", F.lit(0)),
            "hour": F.coalesce(hour, F.lit("1970-01-01").cast("timestamp_ntz")),
            "spread": spread,
        }
    )
    keys = ["no_user", "user", "hour", "spread"]
    hours = keyed.filter("ts is not null").groupBy(*keys).agg(F.min("ts").alias("first_ts"))
    in_life = Window.partitionBy("no_user", "user").orderBy("hour")
    later = hours.select(*keys, F.lead("first_ts").over(in_life).alias("later_ts"))
    in_hour = Window.partitionBy(*keys).orderBy("ts", "event_id")
    followed = keyed.withColumn("in_hour", F.lead("ts").over(in_hour)).join(later, keys, "left")
    return followed.withColumn("next_ts", F.when(F.col("ts").isNotNull(), F.coalesce("in_hour", "later_ts")))
