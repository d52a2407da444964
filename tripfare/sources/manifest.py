"""What the source files hold, and whether every row of them is accounted for."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tripfare.functions.rules import ACCEPTED


def source_manifest(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Rows and bytes per file, and the fleet its name tells (NULL for other names).

    Reads no data columns, so Parquet answers from its footers.
    """
    files = spark.read.schema(T.StructType([])).parquet(*paths)
    fleet = F.nullif(F.regexp_extract("path", r"([a-z]+)_tripdata_[^/]*(/[^/]*)?$", 1), F.lit(""))
    return (
        files.groupBy(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_name").alias("file"),
            F.col("_metadata.file_size").alias("bytes"),
        )
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select("path", "file", "bytes", "row_count", fleet.alias("fleet"))
    )


def reconcile(manifest: DataFrame, counts: DataFrame) -> int:
    """The source total; an error unless files and outcomes add up to the same numbers.

    Compared per fleet where both sides tell it, so errors of two fleets can't cancel.
    """

    def totals(frame: DataFrame, amount: str) -> dict:
        fleet = F.col("fleet") if "fleet" in frame.columns else F.lit(None).cast("string")
        return {r[0]: r[1] for r in frame.groupBy(fleet.alias("fleet")).agg(F.sum(amount)).collect()}

    in_files, classified = totals(manifest, "row_count"), totals(counts, "trip_count")
    total = sum(in_files.values())
    if total != sum(classified.values()):
        raise ValueError(f"source files hold {total} rows, cleaning classified {sum(classified.values())}")
    if None not in in_files and None not in classified:
        for fleet in sorted(in_files.keys() | classified.keys()):
            a, b = in_files.get(fleet, 0), classified.get(fleet, 0)
            if a != b:
                raise ValueError(f"source files of {fleet} hold {a} rows, cleaning classified {b}")
    return total


def require_stored(stored: DataFrame, counts: DataFrame) -> None:
    """An error unless the stored layer holds exactly the rows counted as accepted."""
    written = stored.count()
    counted = counts.filter(F.col("quality_reason") == ACCEPTED).agg(F.coalesce(F.sum("trip_count"), F.lit(0))).first()[0]
    if written != counted:
        raise ValueError(f"{counted} rows were accepted, {written} are stored")
