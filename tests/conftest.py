from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

from tidemark.session import SETTINGS


@pytest.fixture(scope="session")
def spark():
    builder = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
    )
    for k, v in SETTINGS.items():
        builder = builder.config(k, v)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """Build a frame from rows and a DDL schema."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)
