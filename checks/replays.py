"""Queries over what the library itself stores: month files, dictionaries, models, whole studies."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from checks import oracle, queries as q
from tripfare.config import MONTHLY_FILE, StudyConfig
from tripfare.operators import analysis, encoding, evaluation, modeling, trees
from tripfare.operators.durable import durable
from tripfare.operators.ordering import positioned
from tripfare.plans.study import run_study
from tripfare.sources import adapters, monthly, sinks

LEARNERS = ("LinearRegression", "RandomForestRegressor", "GBTRegressor")


# ---- month files with drifting layouts -------------------------------------

def _month_files(spark, trips: DataFrame, fleet: str, prefix: str, as_text: bool, path: str) -> None:
    """Store trips as one month file: as numbers, or as text in another order with other letter case."""
    times = {c: F.col(c).cast("timestamp") for c in ("pickup_datetime", "dropoff_datetime")}
    if as_text:
        # A distance over the limit is written as a word, which is no number.
        distance = F.when(F.col("trip_distance") > 20, "far").otherwise(F.col("trip_distance").cast("string"))
        columns = [
            F.col("DOLocationID").cast("string").alias("dolocationid"),
            distance.alias("Trip_Distance"),
            times["pickup_datetime"].cast("string").alias(f"{prefix}_Pickup_Datetime"),
            times["dropoff_datetime"].cast("string").alias(f"{prefix}_dropoff_datetime"),
            F.col("PULocationID").cast("double").cast("string").alias("PULocationID"),
            F.col("fare_amount").cast("string").alias("fare_amount"),
            F.lit("y").alias("flag"),
        ]
    else:
        columns = [t.alias(f"{prefix}_{c}") for c, t in times.items()]
        columns += [F.col("trip_distance"), F.col("PULocationID").cast("bigint").alias("PULocationID"), F.col("DOLocationID").cast("double").alias("DOLocationID"), F.col("fare_amount")]
    trips.select(*columns).write.parquet(path)


def _event_months(spark, sf) -> str:
    """All events as two fleets of two "months": by id, and the second month of yellow as text."""
    folder = q._fresh(spark, "months")
    trips = durable(adapters.event_trips(spark, sf), "event-trips")
    for fleet, prefix, part in (("yellow", "tpep", 0), ("green", "lpep", 1)):
        for month in (1, 2):
            mine = trips.filter((F.col("event_id") % 2 == part) & (F.floor(F.col("event_id") / 2) % 2 == month - 1))
            _month_files(spark, mine, fleet, prefix, fleet == "yellow" and month == 2, f"{folder}/{MONTHLY_FILE.format(fleet=fleet, year=2024, month=month)}")
    return folder


def monthly_scan(spark, sf):
    """Month files of several layouts as typed trips; a month that isn't there is told."""
    folder = _event_months(spark, sf)
    trips = monthly.load_fleets(spark, folder, years=[2024], months=[1, 2])
    typed = trips.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("pickup_datetime", "dropoff_datetime")})
    try:
        monthly.load_fleets(spark, folder, years=[2024], months=[1, 2, 3])
        missing = "none"
    except ValueError as error:
        missing = str(error)
    return typed.withColumn("third_month", F.lit(missing))


_SCANNED = f"""
scanned AS (
  SELECT * REPLACE (CASE WHEN event_id % 4 = 2 AND trip_distance > 20 THEN NULL ELSE trip_distance END AS trip_distance),
         CASE WHEN event_id % 2 = 0 THEN 'yellow' ELSE 'green' END AS fleet
  FROM event_trips)"""


# ---- order as data -----------------------------------------------------------

def ordered_reports(spark, sf):
    """Every ordered report with the position of each row."""
    trips = durable(q.event_accepted(spark, sf), "accepted")
    splits = q.features.split_frames(trips, adapters.EVENT_CALENDAR)
    reports = {
        "month": (analysis.monthly_trips(trips), "month"),
        "hour": (analysis.hourly_trips(trips), "pickup_hour"),
        "distance_band": (analysis.fare_by_distance(trips), "distance_band"),
        "dropoff": (analysis.highest_fare_dropoffs(trips, q.MINIMUM_TRIPS), "DOLocationID"),
        "regime": (evaluation.regime_counts(splits["train"]), "new_fare_regime"),
        "fare_band": (evaluation.error_by_fare_band(q._with_mean(splits)), "fare_band"),
    }
    tidy = [
        positioned(report).select(F.lit(name).alias("report"), "position", F.col(key).cast("string").alias("item"), "trip_count")
        for name, (report, key) in reports.items()
    ]
    return reduce(DataFrame.unionByName, tidy)


# ---- encodings and learners ---------------------------------------------------

def dictionary_features(spark, sf):
    """Zone places from stored dictionaries, and sparse vectors made from them."""
    known = q._event_history(spark, sf)
    fitted = encoding.fit_zones(known["train"])
    path = q._fresh(spark, "zones")
    fitted.save(path)
    made = encoding.with_vectors(known["test"], encoding.load_encoding(spark, path), modeling.SETTINGS["post_trip"])
    vector = vector_to_array("features")
    return made.select(
        "event_id",
        F.col("PULocationID_index").alias("pickup_index"),
        F.col("DOLocationID_index").alias("dropoff_index"),
        F.size(vector).alias("feature_count"),
        F.element_at(vector, 7).alias("realised_distance"),
        (F.array_position(F.slice(vector, 9, F.size(vector) - 8), 1.0).cast("int") - 1).alias("first_flag"),
    )


def ridge_regression(spark, sf):
    """The linear candidate as configured, on two features: coefficients by term."""
    train = durable(q.order_splits(spark, sf)["train"].select("fare_amount", "trip_distance", "duration_minutes"), "train")
    days = train.withColumn("days", F.col("duration_minutes") / 1440)
    vectors = VectorAssembler(inputCols=["trip_distance", "days"], outputCol="features").transform(days)
    model = modeling.candidates()["LinearRegression"].fit(vectors)
    terms = [("trip_distance", float(model.coefficients[0])), ("days", float(model.coefficients[1])), ("intercept", float(model.intercept))]
    return q.rounded(spark.createDataFrame(terms, "term string, value double"), "value")


# Least squares with a penalty on standardised coefficients. The penalty is given
# in units of the standard deviation of the fare.
_RIDGE = """
  SELECT term, round(value, 4) AS value FROM (
    WITH rows AS (SELECT fare_amount AS y, trip_distance AS a, duration_minutes / 1440 AS b FROM order_accepted WHERE split = 'train'),
    means AS (SELECT avg(y) AS my, avg(a) AS ma, avg(b) AS mb FROM rows),
    moments AS (
      SELECT avg((a - ma) ** 2) AS aa, avg((b - mb) ** 2) AS bb, avg((a - ma) * (b - mb)) AS ab,
             avg((a - ma) * (y - my)) AS ay, avg((b - mb) * (y - my)) AS b_y, sqrt(avg((y - my) ** 2)) AS sy
      FROM rows, means),
    penalised AS (SELECT aa * (1 + 0.1 / sy) AS aa, bb * (1 + 0.1 / sy) AS bb, ab, ay, b_y FROM moments),
    solved AS (SELECT (ay * bb - b_y * ab) / (aa * bb - ab * ab) AS wa, (b_y * aa - ay * ab) / (aa * bb - ab * ab) AS wb FROM penalised)
    SELECT 'trip_distance' AS term, wa AS value FROM solved
    UNION ALL SELECT 'days', wb FROM solved
    UNION ALL SELECT 'intercept', my - wa * ma - wb * mb FROM solved, means)"""


def _fitted(spark, sf):
    """The learners fitted on training trips, saved, and the vectors of the test trips."""
    known = q._event_history(spark, sf)
    prepared = modeling.preprocessing("pre_trip").fit(known["train"])
    made = prepared.transform(known["train"]).select("fare_amount", "features")
    train = modeling.in_parts(durable(made, "train-vectors"), modeling.feature_count(made))
    path = q._fresh(spark, "models")
    models = {name: modeling.candidates()[name].fit(train) for name in LEARNERS}
    sinks.save_model(prepared, f"{path}/preprocessing")
    for name, model in models.items():
        sinks.save_model(model, f"{path}/{name}")
    return path, models, prepared, known["test"]


def model_round_trip(spark, sf):
    """Predictions of every learner before it is saved and after it is loaded."""
    path, models, prepared, test = _fitted(spark, sf)
    again = sinks.load_model(f"{path}/preprocessing")
    parts = []
    for name, model in models.items():
        before = model.transform(prepared.transform(test)).select("event_id", "prediction")
        after = sinks.load_model(f"{path}/{name}").transform(again.transform(test)).select("event_id", F.col("prediction").alias("loaded"))
        joined = durable(before, "before").join(durable(after, "after"), "event_id")
        parts.append(joined.select("event_id", F.lit(name).alias("model"), (F.col("prediction") == F.col("loaded")).alias("same")))
    return reduce(DataFrame.unionByName, parts)


def trees_replayed(spark, sf):
    """Predictions of the saved trees repeated from their table of nodes."""
    path, models, prepared, test = _fitted(spark, sf)
    parts = []
    for name in LEARNERS[1:]:
        rows = models[name].transform(prepared.transform(test)).select("event_id", "prediction", vector_to_array("features").alias("x"))
        nodes = trees.tree_nodes(spark, f"{path}/{name}")
        scored = trees.score_trees(rows, "x", nodes, models[name].getOrDefault("maxDepth"), trees.is_mean(spark, f"{path}/{name}"))
        near = F.abs(F.col("prediction") - F.col("replayed")) < 1e-9
        parts.append(scored.select("event_id", F.lit(name).alias("model"), near.alias("same")))
    return reduce(DataFrame.unionByName, parts)


# ---- the whole study -----------------------------------------------------------

FLEETS = ("yellow", "green")


def whole_study(spark, sf):
    """Month files, cleaning, reports, findings, samples, fits and summaries: all that SQL can say, in tidy rows."""
    folder = _event_months(spark, sf)
    config = StudyConfig(
        limits=adapters.EVENT_LIMITS,
        calendar=adapters.EVENT_CALENDAR,
        clock="wall",
        fractions=dict.fromkeys(FLEETS, 1.0),
        minimum_trips=q.MINIMUM_TRIPS,
        minimum_split_rows=1,
        base_month="2024-01",
    )
    trips = monthly.load_fleets(spark, folder, years=[2024], months=[1, 2])
    paths = [p for f in FLEETS for p in monthly.monthly_paths(folder, f, [2024], [1, 2])]
    tables = run_study(trips, q._fresh(spark, "study"), config, paths)

    def tidy(result, frame, item, value, fleet=None):
        owner = F.lit(fleet) if fleet else F.col("fleet")
        return frame.select(F.lit(result).alias("result"), owner.alias("fleet"), F.col(item).cast("string").alias("item"), F.col(value).cast("double").alias("value"))

    def wide(result, frame, columns, fleet=None):
        owner = F.lit(fleet) if fleet else F.col("fleet")
        pairs = F.array(*[F.struct(F.lit(c).alias("item"), F.col(c).cast("double").alias("value")) for c in columns])
        return frame.select(F.lit(result).alias("result"), owner.alias("fleet"), F.inline(pairs))

    summary = ("accepted_rows", "sample_fraction", "train_rows", "validation_rows", "test_rows")
    coverage = ("unseen_test_rows", "old_regime_train_rows", "new_regime_train_rows")
    rows = [
        tidy("quality", tables["quality_report"], "reason", "trip_count"),
        wide("summary", tables["run_summary"], summary),
        wide("coverage", tables["route_coverage"], coverage),
        tidy("tested", tables["model_comparison"], "setting", "n"),
        tidy("baseline_mae", q.rounded(tables["model_comparison"].filter("setting = 'mean_baseline'"), "mae"), "setting", "mae"),
    ]
    for fleet in FLEETS:
        mine = {name.split("/")[1]: t for name, t in tables.items() if name.startswith(f"{fleet}/")}
        bands = mine["post_trip_error_by_fare"]
        rows += [
            tidy("hour", mine["hourly_trips"], "pickup_hour", "trip_count", fleet),
            tidy("month", mine["monthly_trips"], "month", "trip_count", fleet),
            tidy("band_fare", mine["fare_by_distance"], "distance_band", "mean_fare", fleet),
            tidy("dropoff_fare", mine["highest_fare_dropoffs"], "DOLocationID", "mean_fare", fleet),
            tidy("top_destination", mine["top_destination"], "DOLocationID", "mean_fare", fleet),
            tidy("busiest_hour", mine["busiest_hour"], "pickup_hour", "trip_count", fleet),
            wide("fallback", mine["fallback"], ("historical_distance", "historical_duration"), fleet),
            tidy("regime", mine["regime_counts"], "new_fare_regime", "trip_count", fleet),
            tidy("tested_fares", bands, "fare_band", "trip_count", fleet),
        ]
    return reduce(DataFrame.unionByName, rows)


_EVENTS = oracle.EVENT_TRIPS.replace(
    "FROM event_trips\n),\nevent_accepted", "FROM scanned\n),\nevent_accepted"
).replace("),\nevent_tagged AS", f"),{_SCANNED},\nevent_tagged AS")

_STUDY = oracle._with(_EVENTS) + f""",
  known AS (
    SELECT a.*, t."PULocationID" IS NULL AS unseen FROM event_accepted a LEFT JOIN (
      SELECT DISTINCT fleet, "PULocationID", "DOLocationID" FROM event_accepted WHERE split = 'train') t
    USING (fleet, "PULocationID", "DOLocationID")),
  per_zone AS (
    SELECT * FROM (SELECT fleet, "DOLocationID" AS zone, {oracle.FARE_MEAN} AS mean_fare FROM event_accepted
                   WHERE "DOLocationID" BETWEEN 1 AND 263 GROUP BY ALL HAVING count(*) >= 5)
    QUALIFY row_number() OVER (PARTITION BY fleet ORDER BY mean_fare DESC, zone) <= 5),
  per_hour AS (SELECT fleet, pickup_hour, count(*) AS n FROM event_accepted GROUP BY ALL),
  means AS (SELECT fleet, avg(fare_amount) AS guess FROM event_accepted WHERE split = 'train' GROUP BY ALL),
  splits AS (
    SELECT fleet, count(*) AS accepted_rows, count(*) FILTER (split = 'train') AS train_rows,
           count(*) FILTER (split = 'validation') AS validation_rows, count(*) FILTER (split = 'test') AS test_rows,
           count(*) FILTER (split = 'train' AND new_fare_regime = 0) AS old_rows, count(*) FILTER (split = 'train' AND new_fare_regime = 1) AS new_rows
    FROM event_accepted GROUP BY ALL),
  reasons AS (SELECT unnest(['missing_timestamp', 'outside_period', 'distance_missing_or_nonpositive', 'distance_over_limit',
    'duration_too_short', 'duration_too_long', 'speed_over_limit', 'fare_missing_or_nonpositive', 'fare_over_limit', 'accepted']) AS reason),
  fleets AS (SELECT DISTINCT fleet FROM event_tagged)
  SELECT 'quality' AS result, fleet, 'source total' AS item, count(*)::DOUBLE AS value FROM event_tagged GROUP BY ALL
  UNION ALL SELECT 'quality', f.fleet, reason, count(e.fleet)::DOUBLE FROM fleets f CROSS JOIN reasons
    LEFT JOIN event_tagged e ON e.fleet = f.fleet AND quality_reason = reason GROUP BY ALL
  UNION ALL SELECT 'summary', fleet, unnest(['accepted_rows', 'sample_fraction', 'train_rows', 'validation_rows', 'test_rows']),
    unnest([accepted_rows::DOUBLE, 1.0::DOUBLE, train_rows::DOUBLE, validation_rows::DOUBLE, test_rows::DOUBLE]) FROM splits
  UNION ALL SELECT 'coverage', fleet, unnest(['unseen_test_rows', 'old_regime_train_rows', 'new_regime_train_rows']),
    unnest([(SELECT count(*) FROM known k WHERE k.fleet = s.fleet AND split = 'test' AND unseen)::DOUBLE, old_rows::DOUBLE, new_rows::DOUBLE]) FROM splits s
  UNION ALL SELECT 'tested', fleet, unnest(['mean_baseline', 'pre_trip', 'post_trip']), test_rows::DOUBLE FROM splits
  UNION ALL SELECT 'baseline_mae', fleet, 'mean_baseline', round(avg(abs(fare_amount - guess)), 4)
    FROM event_accepted JOIN means USING (fleet) WHERE split = 'test' GROUP BY ALL
  UNION ALL SELECT 'hour', fleet, pickup_hour::VARCHAR, n::DOUBLE FROM per_hour
  UNION ALL SELECT 'month', fleet, strftime(pickup_datetime, '%Y-%m'), count(*)::DOUBLE FROM event_accepted GROUP BY ALL
  UNION ALL SELECT 'band_fare', fleet, distance_band, {oracle.FARE_MEAN} FROM event_accepted GROUP BY ALL
  UNION ALL SELECT 'dropoff_fare', fleet, zone::VARCHAR, mean_fare FROM per_zone
  UNION ALL SELECT 'top_destination', fleet, zone::VARCHAR, mean_fare FROM (
    SELECT * FROM per_zone QUALIFY row_number() OVER (PARTITION BY fleet ORDER BY mean_fare DESC, zone) = 1)
  UNION ALL SELECT 'busiest_hour', fleet, pickup_hour::VARCHAR, n::DOUBLE FROM (
    SELECT * FROM per_hour QUALIFY row_number() OVER (PARTITION BY fleet ORDER BY n DESC, pickup_hour) = 1)
  UNION ALL SELECT 'fallback', fleet, unnest(['historical_distance', 'historical_duration']),
    unnest([quantile_disc(trip_distance, 0.5), quantile_disc(duration_minutes, 0.5)]) FROM event_accepted WHERE split = 'train' GROUP BY fleet
  UNION ALL SELECT 'regime', fleet, new_fare_regime::VARCHAR, count(*)::DOUBLE FROM event_accepted WHERE split = 'train' GROUP BY ALL
  UNION ALL SELECT 'tested_fares', fleet,
    CASE WHEN fare_amount < 20 THEN 'under_20' WHEN fare_amount < 50 THEN '20_to_50' ELSE '50_plus' END, count(*)::DOUBLE
    FROM event_accepted WHERE split = 'test' GROUP BY ALL"""

_ORDERED = oracle._with(oracle.EVENT_TRIPS, oracle.HOURLY, oracle.BANDS) + f""",
  months AS (SELECT strftime(pickup_datetime, '%Y-%m') AS item, count(*) AS n FROM event_accepted GROUP BY ALL),
  zones AS (SELECT "DOLocationID" AS zone, count(*) AS n, {oracle.FARE_MEAN} AS mean_fare
            FROM event_accepted WHERE "DOLocationID" BETWEEN 1 AND 263 GROUP BY ALL HAVING count(*) >= 5
            ORDER BY mean_fare DESC, zone LIMIT 5),
  regimes AS (SELECT new_fare_regime AS regime, count(*) AS n FROM event_accepted WHERE split = 'train' GROUP BY ALL),
  fares AS (SELECT CASE WHEN fare_amount < 20 THEN 'under_20' WHEN fare_amount < 50 THEN '20_to_50' ELSE '50_plus' END AS item, count(*) AS n
            FROM event_accepted WHERE split = 'test' GROUP BY ALL)
  SELECT 'month' AS report, row_number() OVER (ORDER BY item) AS position, item, n AS trip_count FROM months
  UNION ALL SELECT 'hour', row_number() OVER (ORDER BY pickup_hour), pickup_hour::VARCHAR, trip_count FROM hourly
  UNION ALL SELECT 'distance_band', row_number() OVER (ORDER BY nearest), distance_band, trip_count FROM bands
  UNION ALL SELECT 'dropoff', row_number() OVER (ORDER BY mean_fare DESC, zone), zone::VARCHAR, n FROM zones
  UNION ALL SELECT 'regime', row_number() OVER (ORDER BY regime), regime::VARCHAR, n FROM regimes
  UNION ALL SELECT 'fare_band', row_number() OVER (ORDER BY item), item, n FROM fares"""

QUERIES = {
    f.__name__: f
    for f in (monthly_scan, ordered_reports, dictionary_features, ridge_regression, model_round_trip, trees_replayed, whole_study)
}

_TESTED = oracle._with(oracle.EVENT_TRIPS) + """
  SELECT event_id, model, true AS same FROM event_accepted, (VALUES {models}) m(model) WHERE split = 'test'"""

ORACLE = {
    "monthly_scan": oracle._with(_EVENTS) + """
        SELECT pickup_datetime, dropoff_datetime, trip_distance, fare_amount, "PULocationID", "DOLocationID", fleet,
               'Missing 1 source files' AS third_month FROM scanned""",
    "ordered_reports": _ORDERED,
    "dictionary_features": oracle.ORACLE["encoded_features"],
    "ridge_regression": oracle._with(oracle.ORDER_TRIPS) + _RIDGE,
    "model_round_trip": _TESTED.format(models=", ".join(f"('{m}')" for m in LEARNERS)),
    "trees_replayed": _TESTED.format(models=", ".join(f"('{m}')" for m in LEARNERS[1:])),
    "whole_study": _STUDY,
}
