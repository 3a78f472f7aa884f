import sys
from pathlib import Path

import pytest
from pyspark import cloudpickle
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

import shardstream  # noqa: E402

cloudpickle.register_pickle_by_value(shardstream)

TESTDATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("shardstream-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return str(TESTDATA / "sf0.001")


@pytest.fixture(scope="session")
def events(spark, small):
    return spark.read.parquet(f"{small}/events.parquet")


@pytest.fixture(scope="session")
def log(spark, small):
    from shardstream.plans import tables

    return tables.log(spark, small)
