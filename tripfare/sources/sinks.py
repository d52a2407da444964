"""Stored layers, small result tables, fitted models."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.util import DefaultParamsReader, MLReadable, MLWritable
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tripfare.functions.clock import readable


def write_trips(trips: DataFrame, path: str) -> DataFrame:
    """Store trips by fleet (when present) and pickup year, and read them back.

    Source files hold one month each, so a task writes one or two folders and
    no shuffle is needed. Finer folders would only shed small files, as the
    rows of a month are already together.
    """
    fleet = [c for c in ("fleet",) if c in trips.columns]
    laid_out = trips.withColumn("pickup_year", F.year("pickup_datetime"))
    laid_out.write.mode("overwrite").partitionBy(*fleet, "pickup_year").parquet(path)
    return trips.sparkSession.read.schema(laid_out.schema).parquet(path)


def store(rows: DataFrame, path: str) -> DataFrame:
    """Write rows as they are to a place of their own, and read them back from there."""
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def formatted(table: DataFrame) -> DataFrame:
    """Timestamps of either kind as ``yyyy-MM-dd HH:mm:ss`` text."""
    kinds = (T.TimestampType, T.TimestampNTZType)
    return table.select(
        *[readable(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, kinds) else F.col(f"`{f.name}`") for f in table.schema.fields]
    )


def write_table(table: DataFrame, path: str) -> DataFrame:
    """Store a result table as JSON lines, NULLs included, and return it as stored."""
    text = formatted(table)
    text.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return table.sparkSession.read.schema(text.schema).json(path)


def read_table(spark: SparkSession, path: str, array_file: bool = False) -> DataFrame:
    """Read a stored table; ``array_file`` reads a document that holds one JSON array."""
    return spark.read.option("multiLine", array_file).json(path)


def save_model(model: MLWritable, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> MLReadable:
    """Load any saved stage or pipeline by the class its metadata names."""
    return DefaultParamsReader.loadParamsInstance(path, SparkSession.active())


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)
