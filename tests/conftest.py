import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", f"{tmp_path_factory.mktemp('shared')}/")
        .config("spark.sql.session.timeZone", "America/New_York")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def sf():
    return SMALL


@pytest.fixture
def utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    yield
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")


def rows(frame, *columns):
    """Rows as a sorted list of tuples; NULLs first."""
    frame = frame.select(*columns) if columns else frame
    return sorted(map(tuple, frame.collect()), key=lambda r: tuple((v is not None, v) for v in r))
