"""Monthly Parquet files with drifting schemas → one typed trip table."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tripfare.config import MONTHLY_FILE, TIMESTAMP_PREFIX

TRIP_SCHEMA = T.StructType(
    [
        T.StructField("pickup_datetime", T.TimestampType()),
        T.StructField("dropoff_datetime", T.TimestampType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("PULocationID", T.IntegerType()),
        T.StructField("DOLocationID", T.IntegerType()),
    ]
)


def source_columns(present: Iterable[str], fleet: str) -> dict[str, str]:
    """Trip column → the source column that feeds it, whatever its letter case."""
    by_lower = {name.lower(): name for name in present}
    found = {}
    for name in TRIP_SCHEMA.fieldNames():
        wanted = f"{TIMESTAMP_PREFIX[fleet]}_{name}" if name.endswith("_datetime") else name
        if wanted.lower() not in by_lower:
            raise ValueError(f"{fleet}: missing required column {wanted}")
        found[name] = by_lower[wanted.lower()]
    return found


def lenient_cast(column: Column, source: T.DataType, target: T.DataType) -> Column:
    """Cast that turns a malformed or out-of-range value into NULL.

    Whole numbers arrive as text or doubles in some months ("1.0"), so they
    pass through double.
    """
    if isinstance(target, T.IntegerType) and isinstance(source, (T.StringType, T.FractionalType)):
        column = column.try_cast(T.DoubleType())
    return column.try_cast(target)


def normalize(month: DataFrame, fleet: str) -> DataFrame:
    """Project, cast and rename to the six trip columns."""
    feeds = source_columns(month.columns, fleet)
    return month.select(
        *[
            lenient_cast(F.col(f"`{feeds[f.name]}`"), month.schema[feeds[f.name]].dataType, f.dataType).alias(f.name)
            for f in TRIP_SCHEMA.fields
        ]
    )


def monthly_paths(raw: str, fleet: str, years: Sequence[int], months: Sequence[int]) -> list[str]:
    names = (MONTHLY_FILE.format(fleet=fleet, year=y, month=m) for y in years for m in months)
    return [f"{raw.rstrip('/')}/{name}" for name in names]


def _listed(spark: SparkSession, folder: str) -> set[str]:
    """Names in a folder of any Hadoop file system, from a single listing."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(path):
        return set()
    return {status.getPath().getName() for status in system.listStatus(path)}


def require_files(spark: SparkSession, paths: Sequence[str]) -> None:
    names: dict[str, list[str]] = {}
    for path in paths:
        folder, name = path.rsplit("/", 1)
        names.setdefault(folder, []).append(name)
    missing = sum(len(set(wanted) - _listed(spark, folder)) for folder, wanted in names.items())
    if missing:
        raise ValueError(f"Missing {missing} source files")


def _physical_groups(spark: SparkSession, fleet: str, paths: Sequence[str]) -> dict[tuple, list[str]]:
    """Paths grouped by the names and types of the columns we read.

    Unused columns may drift freely. One footer is read per month; the months
    of a study are a short list.
    """

    def layout(path: str) -> tuple:
        schema = spark.read.parquet(path).schema
        feeds = source_columns(schema.fieldNames(), fleet).values()
        return tuple((name, schema[name].dataType) for name in feeds)

    with ThreadPoolExecutor(8) as pool:
        layouts = list(pool.map(layout, paths))
    groups: dict[tuple, list[str]] = {}
    for key, path in zip(layouts, paths):
        groups.setdefault(key, []).append(path)
    return groups


def load_months(
    spark: SparkSession, raw: str, fleet: str, years: Sequence[int] = range(2020, 2025), months: Sequence[int] = range(1, 13)
) -> DataFrame:
    """All months of one fleet. The union has one branch per distinct layout, not per file."""
    paths = monthly_paths(str(raw), fleet, years, months)
    require_files(spark, paths)
    parts = []
    for columns, files in _physical_groups(spark, fleet, paths).items():
        schema = T.StructType([T.StructField(name, kind) for name, kind in columns])
        parts.append(normalize(spark.read.schema(schema).parquet(*files), fleet))
    return reduce(DataFrame.unionByName, parts)


def load_fleets(
    spark: SparkSession,
    raw: str,
    fleets: Sequence[str] = tuple(TIMESTAMP_PREFIX),
    years: Sequence[int] = range(2020, 2025),
    months: Sequence[int] = range(1, 13),
) -> DataFrame:
    """Every fleet in one frame, told apart by ``fleet``."""
    parts = [load_months(spark, raw, f, years, months).withColumn("fleet", F.lit(f)) for f in fleets]
    return reduce(DataFrame.unionByName, parts)
