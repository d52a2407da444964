"""Saved trees replayed from their nodes: in Spark, and by recursive SQL over the files."""

import duckdb
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from tripfare.operators import evaluation, modeling, trees
from tripfare.sources import sinks

# Walks every row down every tree, one level at a time.
REPLAY = """
WITH RECURSIVE walk AS (
  SELECT r.id, n.tree, n.weight, n.node, n.left, n.right, n.feature, n.threshold, n.categories, n.value
  FROM rows r, nodes n WHERE n.node = 0
  UNION ALL
  SELECT w.id, c.tree, c.weight, c.node, c.left, c.right, c.feature, c.threshold, c.categories, c.value
  FROM walk w JOIN rows r USING (id)
  JOIN nodes c ON c.tree = w.tree AND w.left >= 0
   AND c.node = CASE WHEN coalesce(r.x[w.feature + 1] <= w.threshold, list_contains(w.categories, r.x[w.feature + 1])) THEN w.left ELSE w.right END)
SELECT id, sum(weight * value) / CASE WHEN {mean} THEN count(*) ELSE 1 END AS prediction FROM walk WHERE walk.left < 0 GROUP BY id
"""
METRICS = """
SELECT count(*) AS n, avg(abs(p - fare_amount)) AS mae, sqrt(avg((p - fare_amount) ** 2)) AS rmse,
       1 - avg((p - fare_amount) ** 2) / var_pop(fare_amount) AS r2
FROM (SELECT rows.fare_amount, s.prediction AS p FROM rows JOIN ({replay}) s USING (id))
"""


@pytest.fixture(scope="module")
def trips(spark):
    """Numbers, and zones as flags: splits by threshold and by kind."""
    rows = spark.range(900).select(
        "id",
        (F.col("id") % 97 / 10).alias("trip_distance"),
        (F.col("id") * 7 % 53).cast("double").alias("duration_minutes"),
        F.when(F.col("id") % 11 > 0, F.col("id") % 6).cast("int").alias("PULocationID"),
        (F.col("id") % 4).cast("int").alias("DOLocationID"),
        *[(F.col("id") % k).cast("double").alias(c) for c, k in (("pickup_hour", 24), ("pickup_weekday", 7), ("pickup_month", 12), ("new_fare_regime", 2))],
        (F.col("id") % 13 * 1.5).alias("historical_distance"),
        (F.col("id") % 17 * 2.0).alias("historical_duration"),
    )
    fare = F.col("trip_distance") * 3 + F.when(F.col("PULocationID") == 2, 25).otherwise(0) + F.col("id") % 5
    return rows.withColumn("fare_amount", fare.cast("double"))


@pytest.mark.parametrize("name", ["RandomForestRegressor", "GBTRegressor"])
def test_nodes_repeat_predictions_and_metrics(spark, tmp_path, trips, name):
    prepared = modeling.preprocessing("pre_trip").fit(trips)
    vectors = prepared.transform(trips)
    estimator = modeling.candidates()[name]
    model = estimator.fit(vectors)
    path = f"{tmp_path}/model"
    sinks.save_model(model, path)

    nodes, mean = trees.tree_nodes(spark, path), trees.is_mean(spark, path)
    assert mean == (name == "RandomForestRegressor")
    assert nodes.filter("categories is not null").count() > 0 and nodes.filter("threshold is not null").count() > 0
    rows = model.transform(vectors).select("id", "fare_amount", "prediction", vector_to_array("features").alias("x"))
    replayed = trees.score_trees(rows, "x", nodes, estimator.getMaxDepth(), mean)
    assert replayed.filter(F.abs(F.col("prediction") - F.col("replayed")) > 1e-9).isEmpty() and replayed.count() == 900

    nodes.write.parquet(f"{tmp_path}/nodes")
    rows.write.parquet(f"{tmp_path}/rows")
    connection = duckdb.connect()
    for table in ("nodes", "rows"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}/*.parquet'")
    replay = REPLAY.format(mean=mean)
    by_sql = dict(connection.sql(replay).fetchall())
    assert by_sql == {r.id: pytest.approx(r.prediction, abs=1e-9) for r in rows.collect()}
    want = evaluation.regression_metrics(rows).first()
    assert connection.sql(METRICS.format(replay=replay)).fetchall()[0] == pytest.approx((want.n, want.mae, want.rmse, want.r2), abs=1e-9)


def test_trees_of_one_leaf(spark, tmp_path):
    flat = VectorAssembler(inputCols=["x"], outputCol="features").transform(spark.range(9).select(F.col("id").cast("double").alias("x"), F.lit(4.5).alias("y")))
    for estimator in (RandomForestRegressor(labelCol="y", numTrees=2), GBTRegressor(labelCol="y", maxIter=2)):
        sinks.save_model(estimator.fit(flat), f"{tmp_path}/flat")
        nodes = trees.tree_nodes(spark, f"{tmp_path}/flat")
        scored = trees.score_trees(flat.select(vector_to_array("features").alias("x")), "x", nodes, 5, trees.is_mean(spark, f"{tmp_path}/flat"))
        assert {r.replayed for r in scored.collect()} == {4.5}


def test_learners_get_parts_of_bounded_size(spark, trips, monkeypatch):
    prepared = modeling.preprocessing("pre_trip").fit(trips)
    features = modeling.feature_count(prepared.transform(trips))
    assert features == len(prepared.transform(trips).first().features)
    monkeypatch.setattr(modeling, "PART_BYTES", 60 * (modeling.FEATURE_BYTES * features + modeling.ROW_BYTES))

    def fitted_on(training):
        made = modeling.training_vectors(prepared, "pre_trip", training)
        sizes = made.groupBy(F.spark_partition_id()).count().collect()
        return made, [r["count"] for r in sizes]

    whole = prepared.transform(trips).select("fare_amount", "features")
    many, sizes = fitted_on(trips.coalesce(1))
    assert len(sizes) == 15 and max(sizes) < 2 * 60
    assert many.exceptAll(whole).isEmpty() and whole.exceptAll(many).isEmpty()
    # Parts that are small enough stay as they are.
    assert fitted_on(trips.limit(50).coalesce(1))[1] == [50]
    assert fitted_on(trips.limit(0))[1] == []
