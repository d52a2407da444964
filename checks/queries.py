"""One query per operator, over trips made from whole test tables."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession, functions as F

from tripfare.config import ROUTE, StudyConfig
from tripfare.functions import money
from tripfare.operators import analysis, evaluation, features, findings as found, history, modeling, quality, sampling
from tripfare.operators.durable import durable, shared_folder
from tripfare.operators.joins import lookup_join
from tripfare.plans.study import clean_and_store
from tripfare.sources import adapters, manifest, monthly, sinks

MINIMUM_TRIPS = 5
EXAMPLE_DISTANCE = 46.0
BASE_MONTH = "1998-01"
ORDER_KEYS = ("l_orderkey", "l_linenumber")


# ---- trips ---------------------------------------------------------------

def order_tagged(spark: SparkSession, sf: str) -> DataFrame:
    return quality.tag(adapters.order_trips(spark, sf), adapters.ORDER_LIMITS, "wall")


def event_tagged(spark: SparkSession, sf: str) -> DataFrame:
    return quality.tag(adapters.event_trips(spark, sf), adapters.EVENT_LIMITS, "wall")


def order_accepted(spark, sf):
    return features.enrich(quality.accepted(order_tagged(spark, sf)), adapters.ORDER_CALENDAR)


def event_accepted(spark, sf):
    return features.enrich(quality.accepted(event_tagged(spark, sf)), adapters.EVENT_CALENDAR)


def order_splits(spark, sf):
    return features.split_frames(order_accepted(spark, sf), adapters.ORDER_CALENDAR)


def event_splits(spark, sf):
    return features.split_frames(event_accepted(spark, sf), adapters.EVENT_CALENDAR)


def rounded(table: DataFrame, *columns: str, digits: int = 4) -> DataFrame:
    """Sums are taken in another order per engine; compare them to ``digits`` places."""
    return table.withColumns({c: F.round(c, digits) for c in columns})


# ---- sources and quality -------------------------------------------------

def normalize_trips(spark, sf):
    """Raw months, as text and as numbers, unioned into typed trips."""
    trips = adapters.order_trips(spark, sf)
    early = F.coalesce(F.year("pickup_datetime") < 1998, F.lit(False))
    as_text = trips.filter(early).select(
        F.col("pickup_datetime").cast("string").alias("TPEP_pickup_datetime"),
        F.col("dropoff_datetime").cast("string").alias("tpep_dropoff_datetime"),
        F.col("trip_distance").cast("string").alias("trip_distance"),
        F.col("fare_amount").cast("string").alias("Fare_Amount"),
        F.col("PULocationID").cast("double").cast("string").alias("PULocationID"),
        F.col("DOLocationID").cast("string").alias("dolocationid"),
        "l_orderkey",
    )
    as_numbers = trips.filter(~early).select(
        F.col("DOLocationID").cast("bigint").alias("DOLocationID"),
        F.col("PULocationID").cast("double").alias("PULocationID"),
        "l_linenumber",
        "fare_amount",
        "trip_distance",
        F.col("pickup_datetime").alias("tpep_pickup_datetime"),
        F.col("dropoff_datetime").alias("tpep_dropoff_datetime"),
    )
    months = [monthly.normalize(m, "yellow") for m in (as_text, as_numbers)]
    typed = reduce(DataFrame.unionByName, months)
    return typed.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("pickup_datetime", "dropoff_datetime")})


def source_manifest(spark, sf):
    return manifest.source_manifest(spark, [f"{sf}/lineitem.parquet"]).select("file", "row_count")


def trip_duration(spark, sf):
    trips = quality.with_duration(adapters.event_trips(spark, sf), "wall")
    return trips.select("event_id", "pickup_datetime", "dropoff_datetime", "duration_minutes")


def quality_tags(spark, sf):
    return order_tagged(spark, sf).select(*ORDER_KEYS, "trip_distance", "duration_minutes", "fare_amount", "quality_reason")


def quality_counts(spark, sf):
    return quality.reason_counts(order_tagged(spark, sf))


def quality_counts_events(spark, sf):
    return quality.reason_counts(event_tagged(spark, sf), ["event_type"])


def quality_totals(spark, sf):
    return quality.quality_totals(order_tagged(spark, sf))


def quality_report(spark, sf):
    return quality.quality_report(quality.reason_counts(event_tagged(spark, sf)))


def accepted_trips(spark, sf):
    return quality.accepted(event_tagged(spark, sf))


def quality_example(spark, sf):
    return quality.example_at_distance(order_tagged(spark, sf), EXAMPLE_DISTANCE)


# ---- features and analyses -----------------------------------------------

def trip_features(spark, sf):
    return event_accepted(spark, sf).select(
        "event_id", "pickup_datetime", "pickup_hour", "pickup_weekday", "pickup_month", "new_fare_regime", "distance_band"
    )


def monthly_trips(spark, sf):
    return analysis.monthly_trips(order_accepted(spark, sf))


def hourly_trips(spark, sf):
    return analysis.hourly_trips(event_accepted(spark, sf))


def fare_by_distance(spark, sf):
    return analysis.fare_by_distance(event_accepted(spark, sf))


def highest_fare_dropoffs(spark, sf):
    return analysis.highest_fare_dropoffs(order_accepted(spark, sf), MINIMUM_TRIPS, adapters.ORDER_ZONES)


def shared_scan_reports(spark, sf):
    """The four reports from shared cells, laid end to end."""
    reports = analysis.analyses(durable(event_accepted(spark, sf), "accepted"), MINIMUM_TRIPS)
    keys = {
        "monthly_trips": "month",
        "hourly_trips": "pickup_hour",
        "fare_by_distance": "distance_band",
        "highest_fare_dropoffs": "DOLocationID",
    }
    tidy = [
        reports[name].select(
            F.lit(name).alias("report"),
            F.col(key).cast("string").alias("item"),
            "trip_count",
            (F.col("mean_fare") if "mean_fare" in reports[name].columns else F.lit(None).cast("double")).alias("mean_fare"),
        )
        for name, key in keys.items()
    ]
    return reduce(DataFrame.unionByName, tidy)


def formatted_timestamps(spark, sf):
    return sinks.formatted(adapters.event_trips(spark, sf).select("event_id", "pickup_datetime", "dropoff_datetime", "fare_amount"))


def yearly_trips(spark, sf):
    return found.yearly_trips(monthly_trips(spark, sf))


def lowest_month(spark, sf):
    return rounded(found.lowest_month(monthly_trips(spark, sf), BASE_MONTH), "drop_pct")


def annual_change(spark, sf):
    return rounded(found.annual_change(yearly_trips(spark, sf)), "change_pct")


def busiest_hour(spark, sf):
    return found.busiest_hour(hourly_trips(spark, sf))


def band_extremes(spark, sf):
    return found.band_extremes(event_accepted(spark, sf))


def top_destination(spark, sf):
    return found.top_destination(highest_fare_dropoffs(spark, sf))


# ---- samples, splits, history --------------------------------------------

def hash_sample(spark, sf):
    trips = sampling.hash_sample(adapters.order_trips(spark, sf), ORDER_KEYS, 0.1)
    return trips.select(*ORDER_KEYS, "fare_amount")


def bernoulli_sample(spark, sf):
    trips = sampling.bernoulli_sample(adapters.order_trips(spark, sf), 0.1)
    return trips.select(*ORDER_KEYS, "fare_amount")


def temporal_split_counts(spark, sf):
    return features.split_counts(order_accepted(spark, sf), adapters.ORDER_CALENDAR)


def split_ranges(spark, sf):
    parts = [
        part.select(F.lit(name).alias("split"), "event_id") for name, part in event_splits(spark, sf).items()
    ]
    return reduce(DataFrame.unionByName, parts)


def route_medians(spark, sf):
    return history.route_medians(order_splits(spark, sf)["train"])


def fallback_medians(spark, sf):
    return history.fallback_medians(order_splits(spark, sf)["train"])


def stored_event_splits(spark, sf):
    return features.split_frames(durable(event_accepted(spark, sf), "accepted"), adapters.EVENT_CALENDAR)


def stored_order_splits(spark, sf):
    return features.split_frames(durable(order_accepted(spark, sf), "accepted"), adapters.ORDER_CALENDAR)


def _with_history(splits):
    routes = history.fit_history(splits["train"])
    return {name: history.apply_history(part, routes) for name, part in splits.items()}


def _event_history(spark, sf):
    return _with_history(stored_event_splits(spark, sf))


def route_history(spark, sf):
    return _event_history(spark, sf)["test"].select(
        "event_id", *ROUTE, "historical_distance", "historical_duration", "unseen_pair"
    )


def unseen_routes(spark, sf):
    return _event_history(spark, sf)["test"].filter("unseen_pair").select("event_id", *ROUTE)


def unseen_route_count(spark, sf):
    return history.unseen_count(_event_history(spark, sf)["test"])


def route_coverage(spark, sf):
    parts = [p.withColumn("split", F.lit(name)) for name, p in _event_history(spark, sf).items()]
    return evaluation.route_coverage(reduce(DataFrame.unionByName, parts), ["event_type"])


def run_summary(spark, sf):
    trips = event_accepted(spark, sf)
    sampled = features.with_split(sampling.hash_sample(trips, ["event_id"], 0.5), adapters.EVENT_CALENDAR)
    return evaluation.run_summary(trips, sampled, 0.5, ["event_type"])


# ---- predictions that SQL can repeat -------------------------------------

def regime_counts(spark, sf):
    return evaluation.regime_counts(order_splits(spark, sf)["train"])


def training_mean(spark, sf):
    return rounded(evaluation.training_mean(order_splits(spark, sf)["train"]), "mean_fare")


def _with_mean(splits):
    return evaluation.with_constant(splits["test"], evaluation.training_mean(splits["train"]))


def _with_route_mean(splits):
    """Predict the mean training fare of the route, or of all training trips."""
    train = splits["train"]
    by_route = train.groupBy(*ROUTE).agg(F.avg("fare_amount").alias("route_mean"))
    everywhere = evaluation.training_mean(train).toDF("prediction").scalar()
    return lookup_join(splits["test"], durable(by_route, "route-means"), ROUTE).withColumn(
        "prediction", F.coalesce("route_mean", everywhere)
    )


def baseline_metrics(spark, sf):
    metrics = evaluation.regression_metrics(_with_mean(order_splits(spark, sf)))
    return rounded(metrics, "mae", "rmse", "r2", "within_2_pct", "within_5_pct")


def route_rate_metrics(spark, sf):
    metrics = evaluation.regression_metrics(_with_route_mean(stored_order_splits(spark, sf)))
    return rounded(metrics, "mae", "rmse", "r2", "within_2_pct", "within_5_pct")


def error_by_fare_band(spark, sf):
    return rounded(evaluation.error_by_fare_band(_with_mean(event_splits(spark, sf))), "mae", "rmse")


def worst_residuals(spark, sf):
    worst = evaluation.worst_residuals(_with_mean(event_splits(spark, sf)), tie_break=["event_id"])
    return rounded(worst, "prediction", "absolute_error")


def rmse_change(spark, sf):
    splits = stored_order_splits(spark, sf)
    metrics = evaluation.compare_models(
        {("mean_baseline", "TrainingMean"): _with_mean(splits), ("route_mean", "RouteMean"): _with_route_mean(splits)}
    )
    return rounded(evaluation.rmse_change(metrics, "route_mean", "mean_baseline"), "base_rmse", "rmse", "below_pct")


def rmse_selection(spark, sf):
    """Three predictors learned on training trips, ranked on the validation split."""
    splits = stored_order_splits(spark, sf)
    train, validation = splits["train"], splits["validation"]
    by_pickup = train.groupBy("PULocationID").agg(F.avg("fare_amount").alias("pickup_mean"))
    candidates = {
        ("all", "OverallMean"): _with_mean({"train": train, "test": validation}),
        ("all", "PickupMean"): lookup_join(validation, durable(by_pickup, "pickup-means"), ["PULocationID"]).withColumn(
            "prediction", F.coalesce("pickup_mean", evaluation.training_mean(train).toDF("mean_fare").scalar())
        ),
        ("all", "RouteMean"): _with_route_mean({"train": train, "test": validation}),
    }
    ranking = durable(evaluation.compare_models(candidates), "ranking").select("setting", "model", "position", "n", "rmse")
    best = modeling.winner(ranking).select("setting", F.col("model").alias("best"))
    flagged = ranking.join(F.broadcast(best), "setting").withColumn("selected", F.col("model") == F.col("best"))
    return rounded(flagged.select("model", "position", "n", "rmse", "selected"), "rmse")


# ---- Spark ML ------------------------------------------------------------

def _order_history(spark, sf):
    return _with_history(stored_order_splits(spark, sf))


def encoded_features(spark, sf):
    """Zone indices learned on training trips, and the assembled vector, for test trips."""
    known = _event_history(spark, sf)
    prepared = modeling.preprocessing("post_trip").fit(known["train"])
    vector = vector_to_array("features")
    return prepared.transform(known["test"]).select(
        "event_id",
        F.col("PULocationID_index").cast("int").alias("pickup_index"),
        F.col("DOLocationID_index").cast("int").alias("dropoff_index"),
        F.size(vector).alias("feature_count"),
        F.element_at(vector, 7).alias("realised_distance"),
        # Position of the single pickup flag, counted from 0 after the 8 numbers.
        (F.array_position(F.slice(vector, 9, F.size(vector) - 8), 1.0).cast("int") - 1).alias("first_flag"),
    )


def linear_one_feature(spark, sf):
    """Least squares of fare on distance: slope and intercept."""
    train = durable(order_splits(spark, sf)["train"].select("fare_amount", "trip_distance"), "train")
    vectors = VectorAssembler(inputCols=["trip_distance"], outputCol="features").transform(train)
    model = LinearRegression(labelCol="fare_amount", regParam=0.0, solver="normal").fit(vectors)
    fitted = [(float(model.coefficients[0]), float(model.intercept))]
    return rounded(spark.createDataFrame(fitted, "slope double, intercept double"), "slope", "intercept")


def _scored(known, model_name: str, setting: str = "pre_trip"):
    prepared = modeling.preprocessing(setting).fit(known["train"])
    model = modeling.candidates()[model_name].fit(modeling.training_vectors(prepared, setting, known["train"]))
    predictions = model.transform(prepared.transform(known["test"]))
    return evaluation.compare_models({(setting, model_name): predictions})


def linear_regression(spark, sf):
    return _scored(_order_history(spark, sf), "LinearRegression")


def random_forest(spark, sf):
    return _scored(_order_history(spark, sf), "RandomForestRegressor")


def gbt_regression(spark, sf):
    return _scored(_order_history(spark, sf), "GBTRegressor")


def model_selection(spark, sf):
    known = _event_history(spark, sf)
    fits = modeling.fit_settings(known["train"], known["validation"])
    ranking = reduce(DataFrame.unionByName, [f.ranking for f in fits.values()])
    best = modeling.winner(ranking).select("setting", F.col("model").alias("selected_model"))
    return ranking.join(F.broadcast(best), "setting").withColumn("selected", F.col("model") == F.col("selected_model"))


def _compared(spark, sf):
    known = _event_history(spark, sf)
    scored = {("mean_baseline", "TrainingMean"): _with_mean(known)}
    for setting, fitted in modeling.fit_settings(known["train"], known["validation"]).items():
        scored[(setting, fitted.selected)] = fitted.predict(known["test"])
    return evaluation.compare_models(scored)


def model_comparison(spark, sf):
    return _compared(spark, sf)


def feature_settings_compare(spark, sf):
    metrics = durable(_compared(spark, sf), "comparison")
    pairs = (("pre_trip", "mean_baseline"), ("post_trip", "pre_trip"))
    rows = [
        evaluation.rmse_change(metrics, better, base).select(
            F.lit(better).alias("setting"), F.lit(base).alias("base"), "rmse", "base_rmse", "below_pct"
        )
        for better, base in pairs
    ]
    return reduce(DataFrame.unionByName, rows)


# ---- the production path -------------------------------------------------

EVENT_FLEETS = ("click", "error", "purchase", "signup", "view")


def _fresh(spark, label):
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _cleaned(spark, trips, limits, fleets, label):
    config = StudyConfig(limits=limits, clock="wall", fractions=dict.fromkeys(fleets, 1.0), example_distance=EXAMPLE_DISTANCE)
    return clean_and_store(trips, _fresh(spark, label), config, list(fleets))


def _cleaned_events(spark, sf):
    trips = adapters.event_trips(spark, sf).withColumnRenamed("event_type", "fleet")
    return _cleaned(spark, trips, adapters.EVENT_LIMITS, EVENT_FLEETS, "stored-events")


def _cleaned_orders(spark, sf):
    """Order lines as two fleets, by line number."""
    fleet = F.when(F.col("l_linenumber") % 2 == 0, "even").otherwise("odd")
    trips = adapters.order_trips(spark, sf).withColumn("fleet", fleet)
    return _cleaned(spark, trips, adapters.ORDER_LIMITS, ("even", "odd"), "stored-orders")


def study_quality(spark, sf):
    """Outcomes counted while the accepted trips are stored."""
    return _cleaned_events(spark, sf)[1].filter("trip_count > 0")


def stored_trips(spark, sf):
    """The stored layer, read back."""
    stored = _cleaned_orders(spark, sf)[0]
    years = stored.groupBy("fleet", F.year("pickup_datetime").alias("year")).agg(
        F.count(F.lit(1)).alias("trip_count"), *money.exact_sums(F.col("fare_amount"), "fare")
    )
    return years.select("fleet", "year", "trip_count", money.total("fare").alias("fares"))


def quality_example_by_fleet(spark, sf):
    return _cleaned_orders(spark, sf)[2].withColumn("pickup_datetime", F.col("pickup_datetime").cast("timestamp_ntz"))


def reconciled_files(spark, sf):
    """Rows of the source file beside the rows that cleaning classified; an error if they differ."""
    counts = _cleaned_events(spark, sf)[1]
    files = manifest.source_manifest(spark, [f"{sf}/events.parquet"])
    total = manifest.reconcile(files, counts)
    return files.select("file", "row_count", F.lit(total).cast("bigint").alias("classified"))


def json_round_trip(spark, sf):
    path = _fresh(spark, "months")
    sinks.write_table(monthly_trips(spark, sf), path)
    return sinks.read_table(spark, path).select("month", "trip_count")


def route_lookup_round_trip(spark, sf):
    path = _fresh(spark, "route-history")
    history.fit_history(stored_event_splits(spark, sf)["train"]).save(path)
    return history.load_history(spark, path).lookup.select(*ROUTE, "historical_distance", "historical_duration")


def bernoulli_facts(spark, sf):
    """A sample holds rows of its source only, about as many as asked for."""
    trips = adapters.order_trips(spark, sf).select(*ORDER_KEYS, "fare_amount")
    sample = durable(sampling.bernoulli_sample(trips, 0.1), "sample")
    n, total = sample.count(), trips.count()
    close = abs(n - 0.1 * total) <= 6 * (total * 0.1 * 0.9) ** 0.5
    return spark.createDataFrame([(sample.exceptAll(trips).isEmpty(), close)], "is_subset boolean, within_six_sigma boolean")


def model_comparison_facts(spark, sf):
    """Every setting is scored on all test trips; the one that sees the trip itself is best by far."""
    compared = durable(_compared(spark, sf), "compared")
    best = compared.filter("setting = 'post_trip'").select("rmse").scalar()
    return compared.select("setting", "n", (F.col("rmse") > 2 * best).alias("twice_the_error_of_post_trip"))


def model_selection_facts(spark, sf):
    """Per setting: candidates scored on all validation trips, and the least error selected."""
    ranking = model_selection(spark, sf)
    best = F.min_by("model", F.struct("rmse", "position")) == F.max(F.when(F.col("selected"), F.col("model")))
    return ranking.groupBy("setting").agg(
        F.count(F.lit(1)).alias("candidates"), F.min("n").alias("n"), (best & (F.count_if("selected") == 1)).alias("least_selected")
    )


QUERIES = {
    f.__name__: f
    for f in (
        normalize_trips,
        source_manifest,
        trip_duration,
        quality_tags,
        quality_counts,
        quality_counts_events,
        quality_totals,
        quality_report,
        accepted_trips,
        quality_example,
        trip_features,
        monthly_trips,
        hourly_trips,
        fare_by_distance,
        highest_fare_dropoffs,
        shared_scan_reports,
        formatted_timestamps,
        yearly_trips,
        lowest_month,
        annual_change,
        busiest_hour,
        band_extremes,
        top_destination,
        hash_sample,
        bernoulli_sample,
        temporal_split_counts,
        split_ranges,
        route_medians,
        fallback_medians,
        route_history,
        unseen_routes,
        unseen_route_count,
        route_coverage,
        run_summary,
        regime_counts,
        training_mean,
        baseline_metrics,
        route_rate_metrics,
        error_by_fare_band,
        worst_residuals,
        rmse_change,
        rmse_selection,
        encoded_features,
        linear_one_feature,
        linear_regression,
        random_forest,
        gbt_regression,
        model_selection,
        model_comparison,
        feature_settings_compare,
        study_quality,
        stored_trips,
        quality_example_by_fleet,
        reconciled_files,
        json_round_trip,
        route_lookup_round_trip,
        bernoulli_facts,
        model_comparison_facts,
        model_selection_facts,
    )
}
