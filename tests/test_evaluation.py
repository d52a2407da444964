import math

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tripfare.operators import evaluation


# Errors lie on the tolerances, just inside and just outside them, on both sides.
ERRORS = [0.0, 1.75, -2.0, 2.0, 2.25, -4.5, 5.0, -5.0, 5.25, -11.0]


@pytest.fixture
def predictions(spark):
    data = [(4.0 + 3.5 * i, 4.0 + 3.5 * i + e) for i, e in enumerate(ERRORS)]
    return spark.createDataFrame(data, "fare_amount double, prediction double")


def test_metrics_equal_their_definitions(predictions):
    m = evaluation.regression_metrics(predictions).first()
    fares = [4.0 + 3.5 * i for i in range(len(ERRORS))]
    mean = sum(fares) / len(fares)
    squares = sum(e * e for e in ERRORS)
    assert m.n == len(ERRORS)
    assert m.within_2_pct == 100 * sum(abs(e) <= 2 for e in ERRORS) / len(ERRORS) == 40
    assert m.within_5_pct == 100 * sum(abs(e) <= 5 for e in ERRORS) / len(ERRORS) == 80
    assert m.mae == pytest.approx(sum(map(abs, ERRORS)) / len(ERRORS))
    assert m.rmse == pytest.approx(math.sqrt(squares / len(ERRORS)))
    assert m.r2 == pytest.approx(1 - squares / sum((f - mean) ** 2 for f in fares))


def test_no_spread_and_no_rows(predictions):
    flat = evaluation.regression_metrics(predictions.withColumn("fare_amount", F.lit(6.0))).first()
    assert flat.r2 is None and flat.rmse is not None
    empty = evaluation.regression_metrics(predictions.filter("false")).first()
    assert empty.n == 0 and empty.rmse is None and empty.r2 is None and empty.within_2_pct is None


def test_constant_prediction(predictions):
    mean = evaluation.training_mean(predictions)
    assert rows(evaluation.with_constant(predictions.select("fare_amount"), mean), "prediction") == [(19.75,)] * len(ERRORS)


def test_fare_bands_are_ordered_by_label(spark):
    frame = spark.createDataFrame([(19.99, 20.99), (20.0, 23.0), (49.0, 45.0), (50.0, 52.0)], "fare_amount double, prediction double")
    table = evaluation.error_by_fare_band(frame).collect()
    assert [(r.fare_band, r.trip_count) for r in table] == [("20_to_50", 2), ("50_plus", 1), ("under_20", 1)]
    assert table[0].mae == pytest.approx(3.5) and table[0].rmse == pytest.approx(math.sqrt(12.5))


def test_worst_residuals_break_ties_in_order(spark):
    frame = spark.createDataFrame(
        [("2024-01-02", 1, 1), ("2024-01-01", 2, 1), ("2024-01-01", 1, 2), ("2024-01-01", 1, 1)],
        "pickup_datetime string, PULocationID int, DOLocationID int",
    ).withColumns(
        {
            "pickup_datetime": F.col("pickup_datetime").cast("timestamp"),
            "trip_distance": F.lit(1.0),
            "duration_minutes": F.lit(1.0),
            "fare_amount": F.lit(10.0),
            "prediction": F.lit(4.0),
        }
    )
    worst = evaluation.worst_residuals(frame, rows=3)
    assert [(r.PULocationID, r.DOLocationID) for r in worst.collect()] == [(1, 1), (1, 2), (2, 1)]
    assert len(worst.columns) == 8 and worst.first().absolute_error == 6.0


def test_models_are_compared_in_one_table(predictions):
    better = predictions.withColumn("prediction", F.col("fare_amount") + 1)
    table = evaluation.compare_models({("base", "Mean"): predictions, ("pre", "Linear"): better})
    mae = sum(map(abs, ERRORS)) / len(ERRORS)
    assert rows(table, "setting", "model", "mae") == [("base", "Mean", pytest.approx(mae)), ("pre", "Linear", 1.0)]
    change = evaluation.rmse_change(table, "pre", "base").first()
    assert change.below_pct == pytest.approx((1 - 1 / math.sqrt(sum(e * e for e in ERRORS) / len(ERRORS))) * 100)


def test_coverage_counts_absent_cases_as_zero(spark):
    frame = spark.createDataFrame(
        [("y", "test", True, 1.0), ("y", "test", False, 1.0), ("y", "train", False, 0.0), ("g", "train", False, 0.0)],
        "fleet string, split string, unseen_pair boolean, new_fare_regime double",
    )
    assert rows(evaluation.route_coverage(frame, ["fleet"])) == [("g", 0, 1, 0), ("y", 1, 1, 0)]


def test_summary_of_a_fleet_without_sample(spark):
    trips = spark.createDataFrame([("y",), ("y",), ("g",)], "fleet string")
    sampled = spark.createDataFrame([("y", "train")], "fleet string, split string")
    assert rows(evaluation.run_summary(trips, sampled, 0.5, ["fleet"])) == [("g", 1, 0.5, 0, 0, 0), ("y", 2, 0.5, 1, 0, 0)]
