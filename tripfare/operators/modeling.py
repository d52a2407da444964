"""Feature vectors, three candidate regressors, selection on the validation split."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Mapping, Sequence

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, functions as F

from tripfare.config import ROUTE
from tripfare.operators.evaluation import candidate_predictions, rank_predictions
from tripfare.sources.sinks import store

LABEL = "fare_amount"

# Most bytes of one part of the training rows as boosting holds them in memory: each row
# twice, with four bytes per feature, and the objects around it.
PART_BYTES = 128 << 20
FEATURE_BYTES = 8
ROW_BYTES = 224

# Input columns per setting, and the settings of the estimators.
_KNOWN_BEFORE = (
    "pickup_hour",
    "pickup_weekday",
    "pickup_month",
    "new_fare_regime",
    "historical_distance",
    "historical_duration",
)
_KNOWN_AFTER = ("trip_distance", "duration_minutes")

# What a prediction may look at: before the trip, nothing the trip itself realises.
SETTINGS: Mapping[str, tuple[str, ...]] = {
    "pre_trip": _KNOWN_BEFORE,
    "post_trip": _KNOWN_BEFORE + _KNOWN_AFTER,
}


def preprocessing(setting: str) -> Pipeline:
    """Index and one-hot encode both zones (unseen and NULL kept), then assemble."""
    index = StringIndexer(inputCols=list(ROUTE), outputCols=[f"{c}_index" for c in ROUTE], handleInvalid="keep")
    one_hot = OneHotEncoder(inputCols=index.getOutputCols(), outputCols=[f"{c}_flags" for c in ROUTE], handleInvalid="keep")
    vector = VectorAssembler(inputCols=[*SETTINGS[setting], *one_hot.getOutputCols()], outputCol="features")
    return Pipeline(stages=[index, one_hot, vector])


def feature_count(vectors: DataFrame) -> int:
    """Length of the assembled vectors, which the assembler notes beside their column."""
    return vectors.schema["features"].metadata["ml_attr"]["num_attrs"]


def in_parts(rows: DataFrame, features: int) -> DataFrame:
    """Training rows in parts that hold at most ``PART_BYTES`` once a learner keeps them.

    A scan cuts stored rows by their compressed bytes, which says little about
    their vectors, and gives each core one cut, however large. So the rows of
    every part are counted, and dealt anew if one has too many.
    """
    most = max(1, PART_BYTES // (FEATURE_BYTES * features + ROW_BYTES))
    parts = rows.groupBy(F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("n"))
    largest, total = parts.agg(F.max("n"), F.sum("n")).first()
    return rows.repartition(-(-total // most)) if largest and largest > most else rows


def training_vectors(stages: PipelineModel, setting: str, trips: DataFrame) -> DataFrame:
    """Label and features of trips, in parts of bounded size."""
    rows = trips.select(LABEL, *SETTINGS[setting], *ROUTE)
    return stages.transform(in_parts(rows, feature_count(stages.transform(rows)))).select(LABEL, "features")


def candidates(seed: int = 42) -> dict:
    """Name → estimator, in the order that settles ties."""
    return {
        "LinearRegression": LinearRegression(labelCol=LABEL, regParam=0.1),
        "RandomForestRegressor": RandomForestRegressor(labelCol=LABEL, numTrees=20, maxDepth=5, seed=seed),
        "GBTRegressor": GBTRegressor(labelCol=LABEL, maxIter=20, maxDepth=4, seed=seed),
    }


def winner(ranking: DataFrame, by=("setting",)) -> DataFrame:
    """The model with the lowest validation RMSE per setting; ties go to the first listed."""
    best = F.struct("rmse", "position")
    return ranking.groupBy(*by).agg(F.min_by("model", best).alias("model"), F.min("rmse").alias("rmse"))


@dataclass(frozen=True)
class FittedSetting:
    setting: str
    preprocessing: PipelineModel
    models: Mapping[str, object]
    ranking: DataFrame
    selected: str

    def predict(self, history: DataFrame) -> DataFrame:
        return self.models[self.selected].transform(self.preprocessing.transform(history))


def fit_settings(
    training: DataFrame,
    validation: DataFrame,
    settings: Sequence[str] = tuple(SETTINGS),
    seed: int = 42,
    scored_path: str | None = None,
) -> dict[str, FittedSetting]:
    """Fit every candidate under every setting on training trips; select on validation trips.

    Models are not refitted on validation rows. The fits are independent, so
    they are submitted together, and all candidates are scored in one
    aggregation. With ``scored_path`` it reads their predictions from a table
    stored there, which the ranking can be recomputed from.
    """
    spark = training.sparkSession
    prepared = {setting: preprocessing(setting).fit(training) for setting in settings}
    vectors = {
        setting: [
            training_vectors(stages, setting, part).persist(StorageLevel.MEMORY_AND_DISK)
            for part in (training, validation)
        ]
        for setting, stages in prepared.items()
    }
    jobs = [(setting, name, estimator) for setting in settings for name, estimator in candidates(seed).items()]

    def fit(job):
        setting, _, estimator = job
        return estimator.fit(vectors[setting][0])

    try:
        with ThreadPoolExecutor(len(jobs)) as pool:
            fitted = list(pool.map(inheritable_thread_target(spark)(fit), jobs))
        models = {(setting, name): model for (setting, name, _), model in zip(jobs, fitted)}
        predictions = candidate_predictions({case: model.transform(vectors[case[0]][1]) for case, model in models.items()})
        scores = rank_predictions(store(predictions, scored_path) if scored_path else predictions)
        # One row per candidate; kept as values so the vectors can be released.
        ranking = spark.createDataFrame(scores.collect(), scores.schema)
    finally:
        for frame in (f for pair in vectors.values() for f in pair):
            frame.unpersist()
    best = {row["setting"]: row["model"] for row in winner(ranking).collect()}
    return {
        setting: FittedSetting(
            setting,
            prepared[setting],
            {name: model for (owner, name), model in models.items() if owner == setting},
            ranking.filter(F.col("setting") == setting),
            best[setting],
        )
        for setting in settings
    }
