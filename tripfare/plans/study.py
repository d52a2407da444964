"""The full study: clean, store, analyse, sample, fit, compare."""

from __future__ import annotations

from functools import reduce
from typing import Mapping, Sequence

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, functions as F

from tripfare.config import StudyConfig
from tripfare.functions.rules import ACCEPTED
from tripfare.operators import analysis, evaluation, features, findings, history, modeling, quality, sampling
from tripfare.operators.durable import durable
from tripfare.sources import manifest, sinks

BASELINE = "mean_baseline"


def clean_and_store(
    trips: DataFrame, path: str, config: StudyConfig, fleets: Sequence[str]
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Tag, count and store accepted trips in a single pass over the source.

    Returns the stored trips, the outcome counts per fleet, and per fleet the
    first trip at ``config.example_distance``, noted in the same pass.
    """
    spark = trips.sparkSession
    tagged = quality.tag(trips, config.limits, config.clock)
    tagged, outcomes = quality.observe_outcomes(tagged, fleets, example_distance=config.example_distance)
    stored = sinks.write_trips(quality.accepted(tagged), path)
    return stored, quality.observed_counts(spark, outcomes), quality.observed_examples(spark, outcomes)


def model_study(trips: DataFrame, output: str, config: StudyConfig, fraction: float) -> dict[str, DataFrame]:
    """Sample one fleet, learn route history, select and test a model per setting."""
    spark = trips.sparkSession
    # Stored once: the same rows serve every split, fit and score.
    pool = sinks.store(sampling.bernoulli_sample(trips, fraction, config.seed), f"{output}/sample")
    counts = features.split_counts(pool, config.calendar)
    rows = features.require_split_rows(counts, config.minimum_split_rows)

    splits = features.split_frames(pool, config.calendar)
    routes = history.fit_history(splits["train"])
    routes.save(f"{output}/route_history")
    # Stored once: preprocessing, vectors, coverage and predictions all read it.
    known = {name: durable(history.apply_history(part, routes), f"known-{name}") for name, part in splits.items()}

    mean = evaluation.training_mean(splits["train"])
    scored = {(BASELINE, "TrainingMean"): evaluation.with_constant(known["test"], mean)}
    rankings, results = [], {}
    fits = modeling.fit_settings(known["train"], known["validation"], seed=config.seed, scored_path=f"{output}/validation_predictions")
    for setting, fitted in fits.items():
        rankings.append(fitted.ranking)
        scored_test = fitted.predict(known["test"])
        vectors = [f.name for f in scored_test.schema.fields if isinstance(f.dataType, VectorUDT)]
        predictions = sinks.store(scored_test.drop(*vectors), f"{output}/{setting}/predictions")
        scored[(setting, fitted.selected)] = predictions
        results[f"{setting}_error_by_fare"] = evaluation.error_by_fare_band(predictions)
        results[f"{setting}_worst_errors"] = evaluation.worst_residuals(predictions)
        sinks.save_model(fitted.preprocessing, f"{output}/{setting}/preprocessing")
        sinks.save_model(fitted.models[fitted.selected], f"{output}/{setting}/model")

    labelled = [part.withColumn("split", F.lit(name)) for name, part in known.items()]
    comparison = durable(evaluation.compare_models(scored), "comparison")
    return {
        **results,
        "split_counts": spark.createDataFrame(list(rows.items()), "split string, trip_count bigint"),
        "fallback": routes.fallback_frame(),
        "regime_counts": evaluation.regime_counts(splits["train"]),
        "route_coverage": durable(evaluation.route_coverage(reduce(DataFrame.unionByName, labelled)), "coverage"),
        "validation_ranking": reduce(DataFrame.unionByName, rankings),
        "model_comparison": comparison,
        "rmse_change_pre_trip": evaluation.rmse_change(comparison, "pre_trip", BASELINE),
        "rmse_change_post_trip": evaluation.rmse_change(comparison, "post_trip", "pre_trip"),
    }


def _per_fleet(tables: dict[str, DataFrame], fleets: Sequence[str], name: str) -> DataFrame:
    """One small result table of every fleet, in one frame."""
    parts = [tables[f"{fleet}/{name}"].select(F.lit(fleet).alias("fleet"), "*") for fleet in fleets]
    return reduce(DataFrame.unionByName, parts)


def fleet_summary(counts: DataFrame, splits: DataFrame, fractions: Mapping[str, float]) -> DataFrame:
    """Accepted rows, sample fraction and sampled rows per split of each fleet."""
    accepted = counts.filter(F.col("quality_reason") == ACCEPTED).select("fleet", F.col("trip_count").alias("accepted_rows"))
    fraction = F.coalesce(*[F.when(F.col("fleet") == f, F.lit(float(v))) for f, v in fractions.items()])
    return evaluation.summary_from(accepted, splits, fraction, ["fleet"])


def run_study(
    trips: DataFrame, output: str, config: StudyConfig = StudyConfig(), source_paths: Sequence[str] = ()
) -> dict[str, DataFrame]:
    """Run everything over trips that carry ``fleet``; results come back as stored.

    The outcome counts are always checked against the row totals of the files:
    those of ``source_paths``, or else all that ``trips`` is read from.
    """
    spark = trips.sparkSession
    fleets = tuple(config.fractions)
    paths = list(source_paths) or trips.inputFiles()
    if not paths:
        raise ValueError("trips are not read from files: name the source_paths to reconcile them with")
    stored, counts, examples = clean_and_store(trips, f"{output}/accepted", config, fleets)
    manifest.require_stored(stored, counts)
    files = durable(manifest.source_manifest(spark, paths), "manifest")
    manifest.reconcile(files, counts)
    enriched = features.enrich(stored, config.calendar)

    tables = {
        "source_manifest": files,
        "quality_report": quality.quality_report(counts, ("fleet",)),
        "quality_example": examples,
        "thresholds": quality.thresholds(spark, config.limits),
    }
    over_time = durable(analysis.time_cells(enriched, ("fleet",)), "time-cells")
    over_place = durable(analysis.place_cells(enriched, ("fleet",), config.mapped_zones), "place-cells")
    for fleet in fleets:
        time, place = (c.filter(F.col("fleet") == fleet) for c in (over_time, over_place))
        reports = analysis.reports_from(time, place, config.minimum_trips, config.mapped_zones)
        numbers = findings.findings(reports, place, config.base_month)
        models = model_study(
            enriched.filter(F.col("fleet") == fleet), f"{output}/{fleet}/models", config, config.fractions[fleet]
        )
        tables |= {f"{fleet}/{name}": table for name, table in (reports | numbers | models).items()}
    tables |= {name: _per_fleet(tables, fleets, name) for name in ("model_comparison", "validation_ranking", "route_coverage")}
    tables["run_summary"] = fleet_summary(counts, _per_fleet(tables, fleets, "split_counts"), config.fractions)
    return {name: sinks.write_table(table, f"{output}/results/{name}") for name, table in tables.items()}
