import math

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tripfare.config import ROUTE
from tripfare.operators import durable, features, history, modeling, quality
from tripfare.sources import adapters


@pytest.fixture(scope="module")
def training(spark):
    tagged = quality.tag(adapters.event_trips(spark, "/root/testdata/sf0.001"), adapters.EVENT_LIMITS, "wall")
    trips = features.enrich(quality.accepted(tagged), adapters.EVENT_CALENDAR)
    return features.split_frames(durable.durable(trips, "accepted"), adapters.EVENT_CALENDAR)["train"]


@pytest.fixture(scope="module")
def fitted(training):
    return history.fit_history(training)


def test_medians_match_spark(training, fitted):
    exact = training.groupBy(*ROUTE).agg(
        F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY trip_distance)"),
        F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY duration_minutes)"),
    )
    assert rows(fitted.lookup, *ROUTE, *history.MEDIANS) == rows(exact)
    assert fitted.routes == exact.count()
    approximate = training.agg(*[F.percentile_approx(c, 0.5, 10000) for c in history.MEDIANS.values()]).first()
    assert tuple(fitted.fallback.values()) == tuple(approximate)


@pytest.mark.parametrize("zone", [999, None])
@pytest.mark.parametrize("limit", [0, 10**9])
def test_unseen_and_null_routes_take_the_fallback(training, fitted, zone, limit):
    lost = training.limit(1).withColumns({c: F.lit(zone).cast("int") for c in ROUTE})
    row = history.apply_history(lost, fitted, limit).first()
    assert row.unseen_pair
    assert {n: row[n] for n in history.MEDIANS} == dict(fitted.fallback)


def test_known_routes_keep_their_own_medians(training, fitted):
    known = history.apply_history(training, fitted)
    assert known.filter("unseen_pair").count() == 0
    assert known.count() == training.count()
    assert history.unseen_count(known).first().unseen_rows == 0


def test_null_route_has_medians_but_matches_nothing(spark):
    trips = spark.createDataFrame(
        [(None, 1, 2.0, 3.0), (None, 1, 4.0, 5.0), (1, 1, 9.0, 9.0)],
        "PULocationID int, DOLocationID int, trip_distance double, duration_minutes double",
    )
    fitted = history.fit_history(trips)
    assert (None, 1, 2.0, 3.0) in rows(fitted.lookup, *ROUTE, *history.MEDIANS)
    assert rows(history.apply_history(trips, fitted), "unseen_pair") == [(False,), (True,), (True,)]


def test_save_and_load(spark, fitted, tmp_path):
    fitted.save(f"{tmp_path}/h")
    again = history.load_history(spark, f"{tmp_path}/h")
    assert again.fallback == fitted.fallback and again.keys == fitted.keys and again.routes == fitted.routes
    assert rows(again.lookup) == rows(fitted.lookup)


def _shaken(frame, columns, seed):
    """Each of ``columns`` takes values of its own type, drawn anew for every row."""
    types = dict(frame.dtypes)
    drawn = {c: (F.rand(seed + i) * 50 + 1).cast(types[c]) for i, c in enumerate(columns)}
    return frame.withColumns(drawn)


@pytest.mark.parametrize("setting", sorted(modeling.SETTINGS))
def test_features_depend_on_what_the_setting_allows_and_nothing_else(training, fitted, setting):
    known = durable.durable(history.apply_history(training, fitted), "known")
    stages = modeling.preprocessing(setting).fit(known)
    allowed = [*modeling.SETTINGS[setting], *ROUTE]
    numbers = [c for c, t in known.dtypes if t in ("double", "int", "bigint") and c != "event_id"]

    def vectors(frame):
        return {r.event_id: r.features for r in stages.transform(frame).select("event_id", "features").collect()}

    plain = vectors(known)
    other = [c for c in numbers if c not in allowed]
    assert "fare_amount" in other and ("trip_distance" in other) == (setting == "pre_trip")
    assert vectors(_shaken(known, other, 1)) == plain
    for i, column in enumerate(modeling.SETTINGS[setting]):
        moved = vectors(known.withColumn(column, F.col(column) + 1))
        assert all(moved[e][i] == plain[e][i] + 1 for e in plain), column
    assert all(math.isfinite(v) for vector in plain.values() for v in vector.toArray())


def test_unseen_and_null_zones_share_one_extra_category(training, fitted):
    known = history.apply_history(training, fitted)
    stages = modeling.preprocessing("pre_trip").fit(known)
    zones = known.select("PULocationID").distinct().count()
    odd = known.limit(2).withColumn("PULocationID", F.when(F.monotonically_increasing_id() == 0, 999))
    encoded = stages.transform(odd)
    assert {r.PULocationID_index for r in encoded.collect()} == {float(zones)}
    assert {r.PULocationID_flags.size for r in encoded.collect()} == {zones + 1}


def test_stored_tables_go_to_the_folder_of_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert durable.shared_folder(spark) == folder
    stored = durable.durable(spark.range(3), "numbers")
    assert rows(stored) == [(0,), (1,), (2,)]
    assert all(path.startswith(f"file://{folder}/numbers-") for path in stored.inputFiles())
