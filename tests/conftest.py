import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("borelog-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def at():
    """Seconds after a fixed moment, as a timestamp."""
    start = dt.datetime(2024, 1, 1)
    return lambda seconds: start + dt.timedelta(seconds=seconds)


@pytest.fixture(scope="session")
def episode_rows(spark, at):
    """Hand-made rows: every provenance, missing labels and times, an unknown code, NaN and leading NULLs."""
    nan = float("nan")
    rows = [
        (at(0), None, 1.0, 0, "/e/0/WELL-00019_a.parquet"),
        (at(1), 5.0, nan, 8, "/e/0/WELL-00019_a.parquet"),
        (at(2), None, None, 101, "/e/0/WELL-00019_b.parquet"),
        (at(3), 7.0, None, None, "/e/0/WELL-00019_b.parquet"),
        (None, 9.0, 2.0, 3, "/e/0/WELL-00019_b.parquet"),
        (at(0), None, None, 0, "/e/3/WELL-00029_a.parquet"),
        (at(4), 3.0, 4.0, 102, "/e/3/WELL-00029_a.parquet"),
        (at(0), 1.0, 1.0, 0, "/e/0/DRAWN_00001.parquet"),
        (at(0), 1.0, 1.0, 0, "/e/0/SIMULATED_00001.parquet"),
        (at(6), 2.0, None, 0, "/e/0/elsewhere.parquet"),
        (at(7), None, 6.0, 0, "/e/0/elsewhere.parquet"),
    ]
    schema = "timestamp timestamp, `P-PDG` double, `QGL` double, state int, source_file string"
    return spark.createDataFrame(rows, schema)
