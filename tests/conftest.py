from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starloom.config import prepared  # noqa: E402
from starloom.schema import RAW_SALES, SALES_COLUMNS  # noqa: E402
from starloom.workspace import Workspace  # noqa: E402


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    session = (
        SparkSession.builder.master("local[8]")
        .appName("starloom-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return prepared(session)


@pytest.fixture
def workspace(spark, tmp_path) -> Workspace:
    return Workspace(spark, str(tmp_path))


@pytest.fixture
def raw_sales(spark):
    """Flat rows from dictionaries; columns left out are null."""

    def make(*rows: dict) -> DataFrame:
        data = [tuple(row.get(name) for name in SALES_COLUMNS) for row in rows]
        return spark.createDataFrame(data, RAW_SALES)

    return make


@pytest.fixture
def set_conf(spark):
    """Session settings that are put back after the test."""
    before: dict[str, str | None] = {}

    def change(name: str, value: str) -> None:
        before.setdefault(name, spark.conf.get(name, None))
        spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)
