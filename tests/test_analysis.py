import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tripfare.functions import money
from tripfare.operators import analysis, features, findings, quality
from tripfare.sources import adapters


@pytest.fixture(scope="module")
def trips(spark):
    tagged = quality.tag(adapters.event_trips(spark, "/root/testdata/sf0.001"), adapters.EVENT_LIMITS, "wall")
    kept = features.enrich(quality.accepted(tagged), adapters.EVENT_CALENDAR)
    return kept.persist()


def as_lists(frame):
    return [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in frame.collect()]


def test_shared_cells_give_the_four_reports(trips):
    together = analysis.analyses(trips, minimum=2)
    assert as_lists(together["monthly_trips"]) == as_lists(analysis.monthly_trips(trips))
    assert as_lists(together["hourly_trips"]) == as_lists(analysis.hourly_trips(trips))
    assert as_lists(together["fare_by_distance"]) == as_lists(analysis.fare_by_distance(trips))
    assert as_lists(together["highest_fare_dropoffs"]) == as_lists(analysis.highest_fare_dropoffs(trips, 2))


def test_reports_are_ordered(trips):
    hours = [r.pickup_hour for r in analysis.hourly_trips(trips).collect()]
    assert hours == sorted(hours)
    bands = [r.distance_band for r in analysis.fare_by_distance(trips).collect()]
    order = ["0–1", "1–2", "2–5", "5–10", "10–20", "20–100"]
    assert bands == [b for b in order if b in bands]
    assert analysis.fare_by_distance(trips).columns == ["distance_band", "trip_count", "mean_fare"]
    assert sum(r.trip_count for r in analysis.monthly_trips(trips, ["event_type"]).collect()) == trips.count()


def test_destinations_filter_zones_and_small_counts(spark):
    data = [(0, 900.0)] * 9 + [(264, 900.0)] * 9 + [(1, 5.0)] * 3 + [(2, 5.0)] * 3 + [(3, 50.0)] * 2 + [(263, 4.0)] * 3 + [(None, 9.0)] * 5
    trips = spark.createDataFrame(data, "DOLocationID int, fare_amount double").withColumn("trip_distance", F.lit(1.0))
    top = analysis.highest_fare_dropoffs(trips, minimum=3)
    assert as_lists(top) == [(1, 3, 5.0), (2, 3, 5.0), (263, 3, 4.0)]
    assert as_lists(findings.top_destination(top)) == [(1, 3, 5.0)]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("parts", [1, 3, 20])
def test_equal_means_rank_by_zone_however_rows_are_laid_out(spark, parts):
    """0.1 + 0.2 + 0.3 in any order: as doubles their sums differ, and so would the ranks."""
    fares = [0.1, 0.2, 0.3, 0.7, 1.1, 533.97, 1e9 + 0.01]
    data = [(zone, fare) for zone in (9, 4, 7) for fare in (fares if zone % 2 else fares[::-1])]
    trips = spark.createDataFrame(data, "DOLocationID int, fare_amount double").withColumn("trip_distance", F.lit(1.0)).repartition(parts)
    top = analysis.highest_fare_dropoffs(trips, minimum=7, top=2).collect()
    assert [r.DOLocationID for r in top] == [4, 7] and len({r.mean_fare for r in top}) == 1


def test_reports_are_equal_bit_for_bit(spark, trips):
    seen = set()
    for parts in (1, 2, 20):
        for name, report in analysis.analyses(trips.repartition(parts), minimum=2).items():
            seen.add((name, tuple(map(tuple, report.collect()))))
        seen.add(("extremes", tuple(findings.band_extremes(trips.repartition(parts)).first())))
    assert len(seen) == 5


def test_sums_of_money_are_exact(spark):
    data = [(1, 0.07), (1, -0.15), (1, 9_007_199.740991), (2, None), (3, 1e12), (3, 1e12), (3, 0.000001)]
    sums = spark.createDataFrame(data, "k int, x double").groupBy("k").agg(*money.exact_sums(F.col("x"), "x"), F.count("x").alias("n"))
    found = {r.k: (r.whole, r.rest, r.total, r.exact) for r in sums.select("k", F.col("x_whole").alias("whole"), F.col("x_rest").alias("rest"), money.total("x").alias("total"), (money.exact_mean("x", "n") * 3).alias("exact")).filter("k <> 2").collect()}
    assert found[1][0] * 10**6 + found[1][1] == 9_007_199_740_991 - 80_000
    assert found[3][0] * 10**6 + found[3][1] == 2 * 10**18 + 1
    assert sums.filter("k = 2").first().x_whole is None
    with pytest.raises(Exception):
        spark.createDataFrame([(1, float("nan"))], "k int, x double").agg(*money.exact_sums(F.col("x"), "x")).collect()


def test_views_do_not_collide(trips):
    assert analysis.register_trips(trips) != analysis.register_trips(trips)
    assert analysis.register_trips(trips, "chosen") == "chosen"


def test_findings_settle_ties_on_the_earliest(spark):
    monthly = spark.createDataFrame(
        [("2020-01", 100), ("2020-02", 40), ("2021-03", 40), ("2024-05", 210)], "month string, trip_count bigint"
    )
    low = findings.lowest_month(monthly, "2020-01").first()
    assert (low.month, low.trip_count, low.base_count) == ("2020-02", 40, 100) and low.drop_pct == pytest.approx(60)
    assert findings.lowest_month(monthly, "1999-01").first().drop_pct is None
    yearly = findings.yearly_trips(monthly)
    assert rows(yearly) == [("2020", 140), ("2021", 40), ("2024", 210)]
    change = findings.annual_change(yearly).first()
    assert (change.first_year, change.last_year) == ("2020", "2024") and change.change_pct == pytest.approx(50)
    hourly = spark.createDataFrame([(5, 9), (3, 9), (1, 2)], "pickup_hour int, trip_count bigint")
    assert tuple(findings.busiest_hour(hourly).first()) == (3, 9)


def test_band_extremes_agree_on_trips_and_cells(trips):
    from_trips = findings.band_extremes(trips).first()
    from_cells = findings.band_extremes(analysis.place_cells(trips)).first()
    assert from_trips.nearest_band == from_cells.nearest_band == "0–1"
    assert from_trips.farthest_mean_fare == pytest.approx(from_cells.farthest_mean_fare)


def test_scan_reads_only_what_a_report_needs(spark, tmp_path, trips):
    trips.write.parquet(f"{tmp_path}/trips")
    plan = analysis.fare_by_distance(spark.read.parquet(f"{tmp_path}/trips"))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<trip_distance:double,fare_amount:double,distance_band:string>" in plan
    plain = spark.read.parquet(f"{tmp_path}/trips").drop("pickup_hour", "pickup_month", "distance_band")
    again = features.enrich(plain, adapters.EVENT_CALENDAR)
    over_time, over_place = (
        f(again)._jdf.queryExecution().executedPlan().toString() for f in (analysis.time_cells, analysis.place_cells)
    )
    assert "ReadSchema: struct<pickup_datetime:timestamp_ntz>" in over_time
    assert "ReadSchema: struct<trip_distance:double,fare_amount:double,DOLocationID:int>" in over_place
