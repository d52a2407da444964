"""Saved forests and boosted trees as a table of nodes, and scoring from that table."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

NODE = "node int, feature int, threshold double, categories array<double>, left int, right int, value double"


def tree_nodes(spark: SparkSession, path: str) -> DataFrame:
    """Nodes of a saved tree model: (tree, weight, node, feature, threshold, categories, left, right, value).

    An inner node sends a row to ``left`` if its feature is at most ``threshold``
    or, for a feature of few kinds, among ``categories``. ``left`` is -1 in a leaf.
    """
    weights = spark.read.parquet(f"{path}/treesMetadata").toDF("tree", "about", "weight").select("tree", "weight")
    data = spark.read.parquet(f"{path}/data").toDF("tree", "n")
    kinds = F.col("n.split.numCategories") >= 0
    values = F.col("n.split.leftCategoriesOrThreshold")
    nodes = data.select(
        "tree",
        F.col("n.id").alias("node"),
        F.col("n.split.featureIndex").alias("feature"),
        F.when(~kinds, F.get(values, F.lit(0))).alias("threshold"),
        F.when(kinds, values).alias("categories"),
        F.col("n.leftChild").alias("left"),
        F.col("n.rightChild").alias("right"),
        F.col("n.prediction").alias("value"),
    )
    return nodes.join(F.broadcast(weights), "tree").select("tree", "weight", *[f.split()[0] for f in NODE.split(", ")])


def is_mean(spark: SparkSession, path: str) -> bool:
    """Whether the saved model averages its trees (a forest) or adds them up (boosting)."""
    about = json.loads(spark.read.text(f"{path}/metadata").first()[0])
    return about["class"].endswith("RandomForestRegressionModel")


def _leaf(nodes: Column, vector: Column, depth: int) -> Column:
    """Value of the leaf that a row reaches in one tree; nodes stand in order of their numbers."""

    def step(node: Column, _: Column) -> Column:
        x = F.get(vector, node["feature"])
        left = F.coalesce(x <= node["threshold"], F.array_contains(node["categories"], x))
        return F.when(node["left"] < 0, node).otherwise(F.get(nodes, F.when(left, node["left"]).otherwise(node["right"])))

    return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.get(nodes, F.lit(0)), step)["value"]


def score_trees(rows: DataFrame, vector: str, nodes: DataFrame, depth: int, mean: bool, output: str = "replayed") -> DataFrame:
    """Add the prediction of the trees to rows with an array column ``vector``.

    The node table has at most trees * 2^(depth + 1) rows, whatever the data: it
    reaches the rows as one constant, and each row walks down the trees without
    a shuffle.
    """
    ordered = F.array_sort(F.collect_list(F.struct(*[f.split()[0] for f in NODE.split(", ")])))
    forest = nodes.groupBy("tree", "weight").agg(ordered.alias("nodes"))
    trees = forest.agg(F.array_sort(F.collect_list(F.struct("tree", "weight", "nodes")))).scalar()
    total = lambda value: F.aggregate(F.col("trees"), F.lit(0.0), lambda acc, t: acc + t["weight"] * value(t))
    predicted = total(lambda t: _leaf(t["nodes"], F.col(vector), depth))
    if mean:
        predicted = predicted / total(lambda t: F.lit(1.0))
    return rows.withColumn("trees", trees).withColumn(output, predicted).drop("trees")
