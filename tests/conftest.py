from __future__ import annotations

import os
import sys
from datetime import datetime, timezone

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lendspark.session import configure, ship_package  # noqa: E402

AS_OF = datetime(2026, 4, 20, 12, 0, tzinfo=timezone.utc)


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("lendspark-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    ship_package(session)
    yield configure(session)
    session.stop()


@pytest.fixture(scope="session")
def as_of():
    return AS_OF
