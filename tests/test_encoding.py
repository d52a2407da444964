"""Positions as data, stored zone dictionaries, and vectors made from them."""

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tests.conftest import rows
from tripfare.operators import encoding, modeling
from tripfare.operators.ordering import positioned


@pytest.mark.parametrize("parts", [1, 7])
def test_rows_are_numbered_in_order_over_many_ranges(spark, parts):
    frame = spark.range(0, 5000, 1, parts).select((F.col("id") * 7919 % 5003).alias("x"))
    found = positioned(frame.orderBy("x"))
    assert [r.position for r in found.orderBy("x").collect()] == list(range(1, 5001))
    assert found.columns == ["x", "position"]


def test_positions_of_short_and_empty_results(spark):
    assert rows(positioned(spark.range(3).orderBy(F.desc("id")), "at")) == [(0, 3), (1, 2), (2, 1)]
    assert positioned(spark.range(0).orderBy("id")).count() == 0
    assert rows(positioned(spark.range(9).orderBy(F.desc("id")).limit(2))) == [(7, 2), (8, 1)]


@pytest.fixture(scope="module")
def trips(spark):
    zones = [10] * 5 + [9] * 5 + [3] * 7 + [None] * 2 + [250]
    data = [(z, (i * 3) % 4, float(i), float(i % 5), 2.0 * i) for i, z in enumerate(zones)]
    return spark.createDataFrame(data, "PULocationID int, DOLocationID int, a double, b double, fare_amount double")


def test_zones_rank_by_frequency_then_text(trips, tmp_path, spark):
    fitted = encoding.fit_zones(trips)
    # 9 and 10 are equally frequent; as text "10" comes first.
    assert rows(fitted.dictionaries["PULocationID"]) == [(3, 0), (9, 2), (10, 1), (250, 3)]
    fitted.save(f"{tmp_path}/zones")
    again = encoding.load_encoding(spark, f"{tmp_path}/zones")
    assert again.sizes == fitted.sizes == {"PULocationID": 4, "DOLocationID": 4}
    other = spark.createDataFrame([(77, None), (10, 2)], "PULocationID int, DOLocationID int")
    found = encoding.add_positions(other, again).select("PULocationID_index", "DOLocationID_index")
    assert {r[0]: r[1] < 4 for r in found.collect()} == {4: False, 1: True}


def test_vectors_equal_those_of_the_label_lists(trips, spark):
    numbers = ("a", "b")
    fitted = encoding.fit_zones(trips)
    made = encoding.with_vectors(trips, fitted, numbers)
    settings = dict(modeling.SETTINGS)
    try:
        modeling.SETTINGS = {"plain": numbers}
        listed = modeling.preprocessing("plain").fit(trips).transform(trips)
    finally:
        modeling.SETTINGS = settings
    as_rows = lambda frame: sorted((r.a, tuple(r.x)) for r in frame.select("a", vector_to_array("features").alias("x")).collect())
    assert as_rows(made) == as_rows(listed)
    model = LinearRegression(labelCol="fare_amount", regParam=0.1).fit(made)
    other = LinearRegression(labelCol="fare_amount", regParam=0.1).fit(listed)
    assert list(model.coefficients) == pytest.approx(list(other.coefficients), abs=1e-6)


def test_a_null_number_is_an_error(trips):
    with pytest.raises(Exception, match="b is NULL"):
        encoding.with_vectors(trips.withColumn("b", F.lit(None).cast("double")), encoding.fit_zones(trips), ("a", "b"))


def test_a_million_zones(spark):
    trips = spark.range(1_200_000).select(
        (F.col("id") % 1_000_000).cast("int").alias("PULocationID"), (F.col("id") % 7).cast("int").alias("DOLocationID"), F.col("id").cast("double").alias("a")
    )
    fitted = encoding.fit_zones(trips)
    assert fitted.sizes == {"PULocationID": 1_000_000, "DOLocationID": 7}
    made = encoding.with_vectors(trips.filter("a % 100000 = 0"), fitted, ("a",))
    vectors = [r.features for r in made.select("features").collect()]
    assert {v.size for v in vectors} == {1 + 1_000_001 + 8} and all(len(v.indices) == 3 for v in vectors)
