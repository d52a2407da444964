"""The same results in plain SQL, written independently of the Spark code."""

from __future__ import annotations

# Sums of whole millionths do not depend on the order of addition.
FARE_SUM = "sum(round_even(fare_amount * 1000000, 0)::BIGINT)::DOUBLE"
FARE_MEAN = f"{FARE_SUM} / (count(*) * 1e6)"

ORDER_TRIPS = """
order_trips AS (
  SELECT l_orderkey, l_linenumber,
         o_orderdate AS pickup_datetime, l_shipdate AS dropoff_datetime,
         nullif(l_quantity, 50.0) AS trip_distance, l_extendedprice AS fare_amount,
         c_nationkey AS "PULocationID", s_nationkey AS "DOLocationID",
         date_diff('second', o_orderdate, l_shipdate) / 60::DOUBLE AS duration_minutes
  FROM lineitem
  LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN supplier ON l_suppkey = s_suppkey
),
order_tagged AS (
  SELECT *, CASE
    WHEN pickup_datetime IS NULL OR dropoff_datetime IS NULL THEN 'missing_timestamp'
    WHEN year(pickup_datetime) NOT BETWEEN 1995 AND 2000 THEN 'outside_period'
    WHEN trip_distance IS NULL OR isnan(trip_distance) OR trip_distance <= 0 THEN 'distance_missing_or_nonpositive'
    WHEN trip_distance > 45 THEN 'distance_over_limit'
    WHEN duration_minutes < 1440 THEN 'duration_too_short'
    WHEN duration_minutes > 1440000 THEN 'duration_too_long'
    WHEN trip_distance * 60 / duration_minutes > 0.01 THEN 'speed_over_limit'
    WHEN fare_amount IS NULL OR isnan(fare_amount) OR fare_amount <= 0 THEN 'fare_missing_or_nonpositive'
    WHEN fare_amount > 80000 THEN 'fare_over_limit'
    ELSE 'accepted' END AS quality_reason
  FROM order_trips
),
order_accepted AS (
  SELECT *, CASE
      WHEN pickup_datetime < DATE '1999-01-01' THEN 'train'
      WHEN pickup_datetime < DATE '2000-01-01' THEN 'validation'
      ELSE 'test' END AS split,
    CASE WHEN pickup_datetime >= DATE '1998-12-01' THEN 1.0 ELSE 0.0 END::DOUBLE AS new_fare_regime
  FROM order_tagged WHERE quality_reason = 'accepted'
)"""

EVENT_TRIPS = """
event_trips AS (
  SELECT *, date_diff('second', pickup_datetime, dropoff_datetime) / 60::DOUBLE AS duration_minutes
  FROM (
    SELECT event_id, event_type, ts AS pickup_datetime,
           lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS dropoff_datetime,
           value / 10 AS trip_distance, value AS fare_amount,
           (user_id % 25)::INTEGER AS "PULocationID",
           TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS "DOLocationID"
    FROM events)
),
event_tagged AS (
  SELECT *, CASE
    WHEN pickup_datetime IS NULL OR dropoff_datetime IS NULL THEN 'missing_timestamp'
    WHEN year(pickup_datetime) <> 2024 THEN 'outside_period'
    WHEN trip_distance IS NULL OR isnan(trip_distance) OR trip_distance <= 0 THEN 'distance_missing_or_nonpositive'
    WHEN trip_distance > 20 THEN 'distance_over_limit'
    WHEN duration_minutes < 1 THEN 'duration_too_short'
    WHEN duration_minutes > 360 THEN 'duration_too_long'
    WHEN trip_distance * 60 / duration_minutes > 20 THEN 'speed_over_limit'
    WHEN fare_amount IS NULL OR isnan(fare_amount) OR fare_amount <= 0 THEN 'fare_missing_or_nonpositive'
    WHEN fare_amount > 150 THEN 'fare_over_limit'
    ELSE 'accepted' END AS quality_reason
  FROM event_trips
),
event_accepted AS (
  SELECT *,
    hour(pickup_datetime)::INTEGER AS pickup_hour,
    (dayofweek(pickup_datetime) + 1)::INTEGER AS pickup_weekday,
    month(pickup_datetime)::INTEGER AS pickup_month,
    CASE WHEN pickup_datetime >= TIMESTAMP '2024-01-10 00:00:00' THEN 1.0 ELSE 0.0 END::DOUBLE AS new_fare_regime,
    CASE WHEN trip_distance < 1 THEN '0–1' WHEN trip_distance < 2 THEN '1–2'
         WHEN trip_distance < 5 THEN '2–5' WHEN trip_distance < 10 THEN '5–10'
         WHEN trip_distance < 20 THEN '10–20' ELSE '20–100' END AS distance_band,
    CASE WHEN pickup_datetime < DATE '2024-01-15' THEN 'train'
         WHEN pickup_datetime < DATE '2024-01-22' THEN 'validation'
         ELSE 'test' END AS split
  FROM event_tagged WHERE quality_reason = 'accepted'
)"""

EVENT_ROUTES = """
event_routes AS (
  SELECT "PULocationID", "DOLocationID",
         quantile_disc(trip_distance, 0.5) AS route_distance,
         quantile_disc(duration_minutes, 0.5) AS route_duration
  FROM event_accepted WHERE split = 'train' GROUP BY ALL
),
event_overall AS (
  SELECT quantile_disc(trip_distance, 0.5) AS any_distance, quantile_disc(duration_minutes, 0.5) AS any_duration
  FROM event_accepted WHERE split = 'train'
),
event_known AS (
  SELECT a.*,
         coalesce(route_distance, any_distance) AS historical_distance,
         coalesce(route_duration, any_duration) AS historical_duration,
         route_distance IS NULL AS unseen_pair
  FROM event_accepted a CROSS JOIN event_overall
  LEFT JOIN event_routes r ON a."PULocationID" = r."PULocationID" AND a."DOLocationID" = r."DOLocationID"
)"""

METRICS = """
  count(*) AS n,
  round(avg(abs(prediction - fare_amount)), 4) AS mae,
  round(sqrt(avg((prediction - fare_amount) ** 2)), 4) AS rmse,
  round(1 - avg((prediction - fare_amount) ** 2) / nullif(var_pop(fare_amount), 0), 4) AS r2,
  round(100 * avg((abs(prediction - fare_amount) <= 2)::INTEGER), 4) AS within_2_pct,
  round(100 * avg((abs(prediction - fare_amount) <= 5)::INTEGER), 4) AS within_5_pct"""

ORDER_MEAN = """
order_scored AS (
  SELECT t.*, (SELECT avg(fare_amount) FROM order_accepted WHERE split = 'train') AS prediction
  FROM order_accepted t WHERE split = 'test'
)"""

ORDER_ROUTE_MEAN = """
order_route_scored AS (
  SELECT t.*, coalesce(route_mean, (SELECT avg(fare_amount) FROM order_accepted WHERE split = 'train')) AS prediction
  FROM (SELECT * FROM order_accepted WHERE split = 'test') t
  LEFT JOIN (SELECT "PULocationID", "DOLocationID", avg(fare_amount) AS route_mean
             FROM order_accepted WHERE split = 'train' GROUP BY ALL) r
    ON t."PULocationID" = r."PULocationID" AND t."DOLocationID" = r."DOLocationID"
)"""

EVENT_MEAN = """
event_scored AS (
  SELECT t.*, (SELECT avg(fare_amount) FROM event_accepted WHERE split = 'train') AS prediction
  FROM event_accepted t WHERE split = 'test'
)"""

MONTHLY = """
monthly AS (
  SELECT strftime(pickup_datetime, '%Y-%m') AS month, count(*) AS trip_count
  FROM order_accepted GROUP BY ALL
)"""

DROPOFFS = f"""
dropoffs AS (
  SELECT "DOLocationID", count(*) AS trip_count, {FARE_MEAN} AS mean_fare
  FROM order_accepted WHERE "DOLocationID" BETWEEN 1 AND 24
  GROUP BY ALL HAVING count(*) >= 5 ORDER BY mean_fare DESC, "DOLocationID" LIMIT 5
)"""

HOURLY = """
hourly AS (SELECT pickup_hour, count(*) AS trip_count FROM event_accepted GROUP BY ALL)"""

BANDS = f"""
bands AS (
  SELECT distance_band, count(*) AS trip_count, {FARE_MEAN} AS mean_fare, min(trip_distance) AS nearest
  FROM event_accepted GROUP BY ALL
)"""

# Labels by falling frequency, ties by the label as text; an unseen label takes the count of labels.
ZONE_INDEX = """
pickup_labels AS (
  SELECT "PULocationID" AS zone, (row_number() OVER (ORDER BY count(*) DESC, "PULocationID"::VARCHAR) - 1)::INTEGER AS position
  FROM event_accepted WHERE split = 'train' AND "PULocationID" IS NOT NULL GROUP BY "PULocationID"
),
dropoff_labels AS (
  SELECT "DOLocationID" AS zone, (row_number() OVER (ORDER BY count(*) DESC, "DOLocationID"::VARCHAR) - 1)::INTEGER AS position
  FROM event_accepted WHERE split = 'train' AND "DOLocationID" IS NOT NULL GROUP BY "DOLocationID"
)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


ORACLE = {
    "normalize_trips": _with(ORDER_TRIPS) + """
        SELECT pickup_datetime, dropoff_datetime, trip_distance, fare_amount, "PULocationID", "DOLocationID" FROM order_trips""",
    "source_manifest": "SELECT 'lineitem.parquet' AS file, count(*) AS row_count FROM lineitem",
    "trip_duration": _with(EVENT_TRIPS) + """
        SELECT event_id, pickup_datetime, dropoff_datetime, duration_minutes FROM event_trips""",
    "quality_tags": _with(ORDER_TRIPS) + """
        SELECT l_orderkey, l_linenumber, trip_distance, duration_minutes, fare_amount, quality_reason FROM order_tagged""",
    "quality_counts": _with(ORDER_TRIPS) + """
        SELECT quality_reason, count(*) AS trip_count FROM order_tagged GROUP BY ALL""",
    "quality_counts_events": _with(EVENT_TRIPS) + """
        SELECT event_type, quality_reason, count(*) AS trip_count FROM event_tagged GROUP BY ALL""",
    "quality_totals": _with(ORDER_TRIPS) + """
        SELECT count(*) AS source_rows, count(*) FILTER (WHERE quality_reason = 'accepted') AS accepted_rows FROM order_tagged""",
    "quality_report": _with(EVENT_TRIPS) + """
        SELECT position::INTEGER AS position, reason,
               CASE WHEN reason = 'source total' THEN (SELECT count(*) FROM event_tagged)
                    ELSE (SELECT count(*) FROM event_tagged WHERE quality_reason = reason) END AS trip_count
        FROM (VALUES (0, 'source total'), (1, 'missing_timestamp'), (2, 'outside_period'),
                     (3, 'distance_missing_or_nonpositive'), (4, 'distance_over_limit'),
                     (5, 'duration_too_short'), (6, 'duration_too_long'), (7, 'speed_over_limit'),
                     (8, 'fare_missing_or_nonpositive'), (9, 'fare_over_limit'), (10, 'accepted')) AS v(position, reason)""",
    "accepted_trips": _with(EVENT_TRIPS) + """
        SELECT event_id, event_type, pickup_datetime, dropoff_datetime, trip_distance, fare_amount,
               "PULocationID", "DOLocationID", duration_minutes
        FROM event_tagged WHERE quality_reason = 'accepted'""",
    "quality_example": _with(ORDER_TRIPS) + """
        SELECT pickup_datetime, trip_distance, duration_minutes, fare_amount, quality_reason
        FROM order_tagged WHERE trip_distance = 46.0
        ORDER BY pickup_datetime, duration_minutes NULLS FIRST, fare_amount, quality_reason LIMIT 1""",
    "trip_features": _with(EVENT_TRIPS) + """
        SELECT event_id, pickup_datetime, pickup_hour, pickup_weekday, pickup_month, new_fare_regime, distance_band
        FROM event_accepted""",
    "monthly_trips": _with(ORDER_TRIPS, MONTHLY) + " SELECT month, trip_count FROM monthly ORDER BY month",
    "hourly_trips": _with(EVENT_TRIPS, HOURLY) + " SELECT pickup_hour, trip_count FROM hourly ORDER BY pickup_hour",
    "fare_by_distance": _with(EVENT_TRIPS, BANDS) + """
        SELECT distance_band, trip_count, mean_fare FROM bands ORDER BY nearest""",
    "highest_fare_dropoffs": _with(ORDER_TRIPS, DROPOFFS) + """
        SELECT "DOLocationID", trip_count, mean_fare FROM dropoffs""",
    "shared_scan_reports": _with(EVENT_TRIPS, HOURLY, BANDS) + f"""
        SELECT 'monthly_trips' AS report, strftime(pickup_datetime, '%Y-%m') AS item, count(*) AS trip_count, NULL::DOUBLE AS mean_fare
        FROM event_accepted GROUP BY ALL
        UNION ALL SELECT 'hourly_trips', pickup_hour::VARCHAR, trip_count, NULL FROM hourly
        UNION ALL SELECT 'fare_by_distance', distance_band, trip_count, mean_fare FROM bands
        UNION ALL SELECT 'highest_fare_dropoffs', zone::VARCHAR, trip_count, mean_fare FROM (
            SELECT "DOLocationID" AS zone, count(*) AS trip_count, {FARE_MEAN} AS mean_fare
            FROM event_accepted WHERE "DOLocationID" BETWEEN 1 AND 263
            GROUP BY ALL HAVING count(*) >= 5 ORDER BY mean_fare DESC, zone LIMIT 5)""",
    "formatted_timestamps": _with(EVENT_TRIPS) + """
        SELECT event_id, strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S') AS pickup_datetime,
               strftime(dropoff_datetime, '%Y-%m-%d %H:%M:%S') AS dropoff_datetime, fare_amount
        FROM event_trips""",
    "yearly_trips": _with(ORDER_TRIPS, MONTHLY) + """
        SELECT substr(month, 1, 4) AS year, sum(trip_count)::BIGINT AS trip_count FROM monthly GROUP BY ALL""",
    "lowest_month": _with(ORDER_TRIPS, MONTHLY) + """
        SELECT '1998-01' AS base_month, base AS base_count, month, trip_count,
               round((1 - trip_count / base) * 100, 4) AS drop_pct
        FROM monthly, (SELECT trip_count AS base FROM monthly WHERE month = '1998-01')
        ORDER BY trip_count, month LIMIT 1""",
    "annual_change": _with(ORDER_TRIPS) + """,
        yearly AS (SELECT year(pickup_datetime)::VARCHAR AS year, count(*) AS trip_count FROM order_accepted GROUP BY ALL)
        SELECT a.year AS first_year, b.year AS last_year, a.trip_count AS first_count, b.trip_count AS last_count,
               round((b.trip_count / a.trip_count - 1) * 100, 4) AS change_pct
        FROM yearly a, yearly b
        WHERE a.year = (SELECT min(year) FROM yearly) AND b.year = (SELECT max(year) FROM yearly)""",
    "busiest_hour": _with(EVENT_TRIPS, HOURLY) + """
        SELECT pickup_hour, trip_count FROM hourly ORDER BY trip_count DESC, pickup_hour LIMIT 1""",
    "band_extremes": _with(EVENT_TRIPS, BANDS) + """
        SELECT a.distance_band AS nearest_band, a.mean_fare AS nearest_mean_fare,
               b.distance_band AS farthest_band, b.mean_fare AS farthest_mean_fare
        FROM bands a, bands b
        WHERE a.nearest = (SELECT min(nearest) FROM bands) AND b.nearest = (SELECT max(nearest) FROM bands)""",
    "top_destination": _with(ORDER_TRIPS, DROPOFFS) + """
        SELECT "DOLocationID", trip_count, mean_fare
        FROM dropoffs ORDER BY dropoffs.mean_fare DESC, "DOLocationID" LIMIT 1""",
    "hash_sample": _with(ORDER_TRIPS) + """
        SELECT l_orderkey, l_linenumber, fare_amount FROM order_trips
        WHERE ('0x' || substr(md5('42:' || l_orderkey || ':' || l_linenumber), 1, 8))::BIGINT
              < floor(0.1::DOUBLE * 4294967296)""",
    "temporal_split_counts": _with(ORDER_TRIPS) + " SELECT split, count(*) AS trip_count FROM order_accepted GROUP BY ALL",
    "split_ranges": _with(EVENT_TRIPS) + " SELECT split, event_id FROM event_accepted",
    "route_medians": _with(ORDER_TRIPS) + """
        SELECT "PULocationID", "DOLocationID", quantile_disc(trip_distance, 0.5) AS historical_distance,
               quantile_disc(duration_minutes, 0.5) AS historical_duration
        FROM order_accepted WHERE split = 'train' GROUP BY ALL""",
    "fallback_medians": _with(ORDER_TRIPS) + """
        SELECT quantile_disc(trip_distance, 0.5) AS historical_distance,
               quantile_disc(duration_minutes, 0.5) AS historical_duration
        FROM order_accepted WHERE split = 'train'""",
    "route_history": _with(EVENT_TRIPS, EVENT_ROUTES) + """
        SELECT event_id, "PULocationID", "DOLocationID", historical_distance, historical_duration, unseen_pair
        FROM event_known WHERE split = 'test'""",
    "unseen_routes": _with(EVENT_TRIPS) + """
        SELECT event_id, "PULocationID", "DOLocationID" FROM event_accepted t
        WHERE split = 'test' AND NOT EXISTS (
            SELECT 1 FROM event_accepted s WHERE s.split = 'train'
            AND s."PULocationID" = t."PULocationID" AND s."DOLocationID" = t."DOLocationID")""",
    "unseen_route_count": _with(EVENT_TRIPS, EVENT_ROUTES) + """
        SELECT count(*) AS unseen_rows FROM event_known WHERE split = 'test' AND unseen_pair""",
    "route_coverage": _with(EVENT_TRIPS, EVENT_ROUTES) + """
        SELECT event_type,
               count(*) FILTER (WHERE split = 'test' AND unseen_pair) AS unseen_test_rows,
               count(*) FILTER (WHERE split = 'train' AND new_fare_regime = 0) AS old_regime_train_rows,
               count(*) FILTER (WHERE split = 'train' AND new_fare_regime = 1) AS new_regime_train_rows
        FROM event_known GROUP BY ALL""",
    "run_summary": _with(EVENT_TRIPS) + """
        SELECT event_type, count(*) AS accepted_rows, 0.5::DOUBLE AS sample_fraction,
               count(*) FILTER (WHERE kept AND split = 'train') AS train_rows,
               count(*) FILTER (WHERE kept AND split = 'validation') AS validation_rows,
               count(*) FILTER (WHERE kept AND split = 'test') AS test_rows
        FROM (SELECT *, ('0x' || substr(md5('42:' || event_id), 1, 8))::BIGINT < floor(0.5::DOUBLE * 4294967296) AS kept
              FROM event_accepted)
        GROUP BY ALL""",
    "regime_counts": _with(ORDER_TRIPS) + """
        SELECT new_fare_regime, count(*) AS trip_count FROM order_accepted WHERE split = 'train' GROUP BY ALL""",
    "training_mean": _with(ORDER_TRIPS) + """
        SELECT round(avg(fare_amount), 4) AS mean_fare FROM order_accepted WHERE split = 'train'""",
    "baseline_metrics": _with(ORDER_TRIPS, ORDER_MEAN) + f" SELECT {METRICS} FROM order_scored",
    "route_rate_metrics": _with(ORDER_TRIPS, ORDER_ROUTE_MEAN) + f" SELECT {METRICS} FROM order_route_scored",
    "error_by_fare_band": _with(EVENT_TRIPS, EVENT_MEAN) + """
        SELECT CASE WHEN fare_amount < 20 THEN 'under_20' WHEN fare_amount < 50 THEN '20_to_50' ELSE '50_plus' END AS fare_band,
               count(*) AS trip_count,
               round(avg(abs(prediction - fare_amount)), 4) AS mae,
               round(sqrt(avg((prediction - fare_amount) ** 2)), 4) AS rmse
        FROM event_scored GROUP BY ALL""",
    "worst_residuals": _with(EVENT_TRIPS, EVENT_MEAN) + """
        SELECT event_id, pickup_datetime, "PULocationID", "DOLocationID", trip_distance, duration_minutes, fare_amount,
               round(prediction, 4) AS prediction, round(abs(prediction - fare_amount), 4) AS absolute_error
        FROM event_scored
        ORDER BY abs(prediction - fare_amount) DESC, pickup_datetime, "PULocationID", "DOLocationID", event_id LIMIT 20""",
    "rmse_change": _with(ORDER_TRIPS, ORDER_MEAN, ORDER_ROUTE_MEAN) + """
        SELECT round(base, 4) AS base_rmse, round(other, 4) AS rmse, round((1 - other / base) * 100, 4) AS below_pct
        FROM (SELECT (SELECT sqrt(avg((prediction - fare_amount) ** 2)) FROM order_scored) AS base,
                     (SELECT sqrt(avg((prediction - fare_amount) ** 2)) FROM order_route_scored) AS other)""",
    "rmse_selection": _with(ORDER_TRIPS) + """,
        train AS (SELECT * FROM order_accepted WHERE split = 'train'),
        held AS (SELECT * FROM order_accepted WHERE split = 'validation'),
        overall AS (SELECT avg(fare_amount) AS guess FROM train),
        pickups AS (SELECT "PULocationID" AS zone, avg(fare_amount) AS guess FROM train GROUP BY ALL),
        routes AS (SELECT "PULocationID" AS pu, "DOLocationID" AS d, avg(fare_amount) AS guess FROM train GROUP BY ALL),
        scored AS (
          SELECT 'OverallMean' AS model, 0 AS position, count(*) AS n, sqrt(avg((guess - fare_amount) ** 2)) AS error FROM held, overall
          UNION ALL
          SELECT 'PickupMean', 1, count(*), sqrt(avg((coalesce(pickups.guess, overall.guess) - fare_amount) ** 2))
          FROM held CROSS JOIN overall LEFT JOIN pickups ON zone = "PULocationID"
          UNION ALL
          SELECT 'RouteMean', 2, count(*), sqrt(avg((coalesce(routes.guess, overall.guess) - fare_amount) ** 2))
          FROM held CROSS JOIN overall LEFT JOIN routes ON pu = "PULocationID" AND d = "DOLocationID")
        SELECT model, position::INTEGER AS position, n, round(error, 4) AS rmse,
               model = (SELECT model FROM scored ORDER BY error, position LIMIT 1) AS selected
        FROM scored""",
    "encoded_features": _with(EVENT_TRIPS, ZONE_INDEX) + """
        SELECT event_id,
               coalesce(p.position, (SELECT count(*) FROM pickup_labels))::INTEGER AS pickup_index,
               coalesce(d.position, (SELECT count(*) FROM dropoff_labels))::INTEGER AS dropoff_index,
               (8 + (SELECT count(*) + 1 FROM pickup_labels) + (SELECT count(*) + 1 FROM dropoff_labels))::INTEGER AS feature_count,
               trip_distance AS realised_distance,
               coalesce(p.position, (SELECT count(*) FROM pickup_labels))::INTEGER AS first_flag
        FROM event_accepted t
        LEFT JOIN pickup_labels p ON t."PULocationID" = p.zone
        LEFT JOIN dropoff_labels d ON t."DOLocationID" = d.zone
        WHERE split = 'test'""",
    "linear_one_feature": _with(ORDER_TRIPS) + """
        SELECT round(regr_slope(fare_amount, trip_distance), 4) AS slope,
               round(regr_intercept(fare_amount, trip_distance), 4) AS intercept
        FROM order_accepted WHERE split = 'train'""",
    "study_quality": _with(EVENT_TRIPS) + """
        SELECT event_type AS fleet, quality_reason, count(*) AS trip_count FROM event_tagged GROUP BY ALL""",
    "stored_trips": _with(ORDER_TRIPS) + f"""
        SELECT CASE WHEN l_linenumber % 2 = 0 THEN 'even' ELSE 'odd' END AS fleet, year(pickup_datetime)::INTEGER AS year,
               count(*) AS trip_count, {FARE_SUM} / 1e6 AS fares
        FROM order_accepted GROUP BY ALL""",
    "quality_example_by_fleet": _with(ORDER_TRIPS) + """
        SELECT fleet, pickup_datetime, trip_distance, duration_minutes, fare_amount, quality_reason
        FROM (SELECT *, CASE WHEN l_linenumber % 2 = 0 THEN 'even' ELSE 'odd' END AS fleet FROM order_tagged)
        WHERE trip_distance = 46.0
        QUALIFY row_number() OVER (PARTITION BY fleet ORDER BY pickup_datetime NULLS FIRST, duration_minutes NULLS FIRST,
                                   fare_amount NULLS FIRST, quality_reason) = 1""",
    "reconciled_files": "SELECT 'events.parquet' AS file, count(*) AS row_count, count(*) AS classified FROM events",
    "json_round_trip": _with(ORDER_TRIPS, MONTHLY) + " SELECT month, trip_count FROM monthly",
    "route_lookup_round_trip": _with(EVENT_TRIPS, EVENT_ROUTES) + """
        SELECT "PULocationID", "DOLocationID", route_distance AS historical_distance, route_duration AS historical_duration
        FROM event_routes""",
    "bernoulli_facts": "SELECT true AS is_subset, true AS within_six_sigma",
    "model_comparison_facts": _with(EVENT_TRIPS) + """
        SELECT setting, count(*) AS n, setting <> 'post_trip' AS twice_the_error_of_post_trip
        FROM event_accepted, (VALUES ('mean_baseline'), ('pre_trip'), ('post_trip')) s(setting)
        WHERE split = 'test' GROUP BY setting""",
    "model_selection_facts": _with(EVENT_TRIPS) + """
        SELECT setting, 3::BIGINT AS candidates, count(*) AS n, true AS least_selected
        FROM event_accepted, (VALUES ('pre_trip'), ('post_trip')) s(setting)
        WHERE split = 'validation' GROUP BY setting""",
}
