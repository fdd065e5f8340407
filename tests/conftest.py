import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    from candlemill.session import SETTINGS

    builder = SparkSession.builder.master("local[*]").appName("tests")
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    session = (
        builder.config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def smallest():
    return "/root/testdata/sf0.001"


@pytest.fixture
def rows(spark):
    """Sorted tuples of a frame, NULLs first."""

    def as_tuples(df):
        return sorted((tuple(row) for row in df.collect()), key=lambda row: [(v is not None, v) for v in row])

    return as_tuples
