import datetime
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

from shared import SALES_SCHEMA

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("spark")
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("shelfcast-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(scratch / "warehouse"))
        .config("spark.driver.memory", "8g")
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(str(scratch / "checkpoints"))
    yield session
    session.stop()


@pytest.fixture
def sales_rows():
    """Four days of one series: a plain day, a promoted one, and the same again."""
    first = datetime.date(2024, 3, 7)
    volumes = [(8.0, 0.0), (30.0, 2.0), (16.0, 0.0), (42.0, 1.0)]
    return [(first + datetime.timedelta(days=i), 5, "TEA", *row) for i, row in enumerate(volumes)]


@pytest.fixture
def sales(spark, sales_rows):
    return spark.createDataFrame(sales_rows, SALES_SCHEMA)
