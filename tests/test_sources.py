import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tripfare.operators import quality
from tripfare.sources import manifest, monthly, sinks

RAW = [("2023-06-30 23:58:41", "2023-07-01 00:17:03", "7.25", "31.9", "140", "88")]
RAW_SCHEMA = (
    "tpep_pickup_datetime string, tpep_dropoff_datetime string, trip_distance string, "
    "fare_amount string, PULocationID string, DOLocationID string"
)


@pytest.fixture
def raw(spark):
    return spark.createDataFrame(RAW, RAW_SCHEMA)


@pytest.fixture
def months(spark, raw, tmp_path):
    """Two text months, two numeric ones with different zone types, and a green one."""

    def store(frame, name):
        frame.write.parquet(f"{tmp_path}/{name}.parquet")

    store(raw, "yellow_tripdata_2024-01")
    # Columns sorted by name among others that nobody reads.
    shuffled = raw.select(F.lit("card").alias("payment"), *sorted(raw.columns), F.lit(None).cast("double").alias("tip"))
    store(shuffled, "yellow_tripdata_2024-02")
    typed = monthly.normalize(raw, "yellow").withColumnsRenamed(
        {"pickup_datetime": "tpep_pickup_datetime", "dropoff_datetime": "tpep_dropoff_datetime"}
    )
    store(typed.withColumn("PULocationID", F.col("PULocationID").cast("bigint")), "yellow_tripdata_2024-03")
    store(typed.withColumn("PULocationID", F.col("PULocationID").cast("double")), "yellow_tripdata_2024-04")
    green = raw.withColumnsRenamed({c: c.replace("tpep", "lpep") for c in raw.columns})
    store(green, "green_tripdata_2024-01")
    return str(tmp_path)


def test_months_with_drifting_layouts_become_one_table(spark, months):
    trips = monthly.load_months(spark, months, "yellow", [2024], [1, 2, 3, 4])
    assert trips.schema == monthly.TRIP_SCHEMA
    assert len(set(rows(trips))) == 1 and trips.count() == 4
    first = sinks.formatted(trips).first()
    assert tuple(first) == ("2023-06-30 23:58:41", "2023-07-01 00:17:03", 7.25, 31.9, 140, 88)


def test_one_union_branch_per_layout(spark, months):
    groups = monthly._physical_groups(spark, "yellow", monthly.monthly_paths(months, "yellow", [2024], [1, 2, 3, 4]))
    assert sorted(len(files) for files in groups.values()) == [1, 1, 2]


def test_fleets_are_labelled(spark, months):
    trips = monthly.load_fleets(spark, months, ["yellow", "green"], [2024], [1])
    assert rows(trips, "fleet") == [("green",), ("yellow",)]


def test_missing_column_and_missing_files_are_errors(spark, raw, months):
    with pytest.raises(ValueError, match="missing required column fare_amount"):
        monthly.normalize(raw.drop("fare_amount"), "yellow")
    with pytest.raises(ValueError, match="missing required column lpep_pickup_datetime"):
        monthly.normalize(raw, "green")
    with pytest.raises(ValueError, match="Missing 2 source files"):
        monthly.load_months(spark, months, "yellow", [2024], [1, 5, 6])
    with pytest.raises(ValueError, match="Missing 1 source files"):
        monthly.load_months(spark, f"{months}/nowhere", "yellow", [2024], [1])


def test_names_match_in_any_case(raw):
    loud = raw.toDF(*[c.upper() for c in raw.columns])
    assert monthly.normalize(loud, "yellow").first() == monthly.normalize(raw, "yellow").first()


def test_malformed_values_become_null(spark):
    bad = spark.createDataFrame(
        [("soon", "2024-01-01 12:30:00", "far", "", "1.0", "12345678901")], RAW_SCHEMA
    )
    row = sinks.formatted(monthly.normalize(bad, "yellow")).first()
    assert tuple(row) == (None, "2024-01-01 12:30:00", None, None, 1, None)
    not_a_number = spark.createDataFrame([(float("nan"),)], "z double")
    cast = monthly.lenient_cast(F.col("z"), not_a_number.schema["z"].dataType, monthly.TRIP_SCHEMA["PULocationID"].dataType)
    assert not_a_number.select(cast).first()[0] is None


def test_zone_free_source_is_read_in_the_session_zone(spark, raw):
    naive = raw.withColumn("tpep_pickup_datetime", F.col("tpep_pickup_datetime").cast("timestamp_ntz"))
    assert monthly.normalize(naive, "yellow").first() == monthly.normalize(raw, "yellow").first()


def test_manifest_and_reconciliation(spark, months):
    paths = monthly.monthly_paths(months, "yellow", [2024], [1, 2, 3, 4])
    files = manifest.source_manifest(spark, paths)
    assert files.agg(F.sum("row_count")).first()[0] == 4
    assert files.filter("bytes <= 0").count() == 0
    counts = quality.reason_counts(quality.tag(monthly.load_months(spark, months, "yellow", [2024], [1, 2, 3, 4])))
    assert manifest.reconcile(files, counts) == 4
    with pytest.raises(ValueError, match="4 rows, cleaning classified 0"):
        manifest.reconcile(files, counts.filter("false"))


def test_manifest_reads_no_data_columns(spark, sf):
    plan = manifest.source_manifest(spark, [f"{sf}/lineitem.parquet"])._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan


def test_stored_trips_are_pruned_by_year(spark, tmp_path):
    trips = spark.sql(
        "SELECT 'yellow' AS fleet, make_timestamp(2020 + id % 5, 3, 1, 8, 0, 0) AS pickup_datetime, id FROM range(50)"
    )
    path = f"{tmp_path}/accepted"
    stored = sinks.write_trips(trips, path)
    assert stored.count() == 50
    assert sinks.write_trips(trips.limit(10), path).count() == 10  # replaces
    plan = stored.filter("pickup_year >= 2024")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pickup_year" in plan


def test_tables_round_trip_with_readable_times(spark, tmp_path):
    table = spark.sql(
        "SELECT timestamp'2024-02-29 13:17:33' AS zoned, timestamp_ntz'2024-02-29 13:17:33.5' AS plain, "
        "CAST(NULL AS DOUBLE) AS nothing, 3 AS n"
    )
    stored = sinks.write_table(table, f"{tmp_path}/t")
    assert tuple(stored.first()) == ("2024-02-29 13:17:33", "2024-02-29 13:17:33", None, 3)
    again = sinks.read_table(spark, f"{tmp_path}/t")
    assert set(again.columns) == {"zoned", "plain", "nothing", "n"}


def test_array_documents_can_be_read(spark, tmp_path):
    (tmp_path / "saved.json").write_text('[\n {"month": "2020-01", "trip_count": 3},\n {"month": "2020-02", "trip_count": 1}\n]\n')
    assert rows(sinks.read_table(spark, f"{tmp_path}/saved.json", array_file=True)) == [("2020-01", 3), ("2020-02", 1)]
