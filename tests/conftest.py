from __future__ import annotations

import sys
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

RUN_TS = datetime(2024, 1, 1, 12, 0)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tallyworks-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def sales(spark):
    """Builds a raw sales frame; fields that are not named take a valid value."""
    good = {
        "OrderID": "1",
        "ProductID": "A",
        "SaleAmount": "10.0",
        "OrderDate": "01/05/2023",
        "Region": "East",
        "CustomerID": "C1",
        "Discount": "0.1",
        "Currency": "USD",
    }

    def build(*rows: dict):
        schema = ", ".join(f"{name} string" for name in good)
        return spark.createDataFrame([tuple({**good, **row}.values()) for row in rows], schema)

    return build


@pytest.fixture
def products(spark):
    def build(*rows):
        return spark.createDataFrame(list(rows), "ProductID string, ProductName string, Category string")

    return build


@pytest.fixture
def quotes(spark):
    """Builds a frame of rate quotes from (from, to, rate text, source, time)."""

    def build(*rows):
        typed = [(a, b, None if rate is None else Decimal(rate), source, ts) for a, b, rate, source, ts in rows]
        schema = "from_currency string, to_currency string, rate decimal(10,6), source string, ts timestamp_ntz"
        return spark.createDataFrame(typed, schema)

    return build
