"""Zones as places in stored dictionaries, and feature vectors made from them."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from typing import Mapping, Sequence

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tripfare.config import ROUTE
from tripfare.operators.durable import durable, shared_folder
from tripfare.operators.joins import lookup_join
from tripfare.operators.ordering import positioned

_SPARSE = 0


@dataclass(frozen=True)
class ZoneEncoding:
    """Per column a stored dictionary (column, position) and its number of zones."""

    dictionaries: Mapping[str, DataFrame]
    sizes: Mapping[str, int]

    def save(self, path: str) -> None:
        for column, dictionary in self.dictionaries.items():
            dictionary.write.mode("overwrite").parquet(f"{path}/{column}")


def load_encoding(spark: SparkSession, path: str, columns: Sequence[str] = ROUTE) -> ZoneEncoding:
    dictionaries = {c: spark.read.parquet(f"{path}/{c}") for c in columns}
    return ZoneEncoding(dictionaries, {c: d.count() for c, d in dictionaries.items()})


def fit_zones(training: DataFrame, columns: Sequence[str] = ROUTE) -> ZoneEncoding:
    """Zones of training trips from the most frequent on; ties in order of their names as text.

    Zones are counted, sorted and numbered as tables, and none is brought to
    the driver: there may be millions.
    """
    dictionaries = {}
    for column in columns:
        counts = training.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
        ranked = positioned(counts.orderBy(F.desc("n"), F.col(column).cast("string")))
        dictionaries[column] = durable(ranked.select(column, (F.col("position") - 1).cast("int").alias("position")), "zones")
    return ZoneEncoding(dictionaries, {c: d.count() for c, d in dictionaries.items()})


def add_positions(trips: DataFrame, encoding: ZoneEncoding) -> DataFrame:
    """``{column}_index`` per encoded column; an unseen or NULL zone takes the place after the last."""
    for column, dictionary in encoding.dictionaries.items():
        size = encoding.sizes[column]
        joined = lookup_join(trips, dictionary.withColumnRenamed("position", f"{column}_index"), [column], lookup_rows=size)
        trips = joined.withColumn(f"{column}_index", F.coalesce(f"{column}_index", F.lit(size)))
    return trips


def sparse_vector(numbers: Sequence[str], encoding: ZoneEncoding) -> Column:
    """Numbers, then one flag per zone and one for other zones, as the fields of a sparse vector."""
    places, at = [F.lit(i) for i in range(len(numbers))], len(numbers)
    for column, size in encoding.sizes.items():
        places.append(F.col(f"{column}_index") + at)
        at += size + 1
    values = [F.col(n).cast("double") for n in numbers] + [F.lit(1.0)] * len(encoding.sizes)
    return F.struct(
        F.lit(_SPARSE).cast("byte").alias("type"), F.lit(at).alias("size"), F.array(*places).alias("indices"), F.array(*values).alias("values")
    )


def with_vectors(trips: DataFrame, encoding: ZoneEncoding, numbers: Sequence[str], output: str = "features") -> DataFrame:
    """Stored trips with a vector column for Spark ML, made without Python and without a list of zones.

    A NULL number is an error, as it has no place in a vector.
    """
    spark = trips.sparkSession
    known = [F.when(F.col(n).isNull(), F.raise_error(F.lit(f"{n} is NULL"))).otherwise(F.col(n)).alias(n) for n in numbers]
    plain = add_positions(trips.select(*[c for c in trips.columns if c not in numbers], *known), encoding)
    stored = plain.withColumn(output, sparse_vector(numbers, encoding))
    path = f"{shared_folder(spark)}/vectors-{uuid.uuid4().hex}"
    stored.write.parquet(path)
    # A vector is stored as these four fields: read back under its own type.
    schema = T.StructType([T.StructField(f.name, VectorUDT() if f.name == output else f.dataType) for f in stored.schema.fields])
    return spark.read.schema(schema).parquet(path)
