from __future__ import annotations

import contextlib
import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def limits(spark):
    """Temporarily lowers tuning limits so that the large-data plans run on small data."""

    @contextlib.contextmanager
    def lowered(**values):
        for key, value in values.items():
            spark.conf.set(f"spark.alula.{key}", str(value))
        try:
            yield
        finally:
            for key in values:
                spark.conf.unset(f"spark.alula.{key}")

    return lowered
