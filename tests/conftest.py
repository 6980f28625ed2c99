import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parents[1])]

SMALLEST = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def silver(spark):
    from funnelspark.queries import silver_of

    return silver_of(spark, SMALLEST)


@pytest.fixture
def bronze_rows(spark):
    """Bronze rows from (payload JSON, insert_date text) pairs."""

    def build(rows):
        frame = spark.createDataFrame(rows, "payload string, insert_date string")
        return frame.selectExpr(
            "try_parse_json(payload) AS payload", "cast(insert_date AS timestamp_ntz) AS insert_date"
        )

    return build
