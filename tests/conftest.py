from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("eventlake-tests")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


T0 = "2024-01-01T10:00:00+00:00"

# (offset, user, product, type, price, time); NULL is None.
EDGE_EVENTS = [
    (0, 1, 10, "view", 0.0, T0),
    (1, 1, 10, "view", 0.0, T0),
    (2, 1, 10, " View ", 0.0, T0),
    (3, 1, 10, "purchase", 12.345678, "2024-01-01T15:30:00+05:30"),
    (4, 2, 11, "cart", 0.0, "2024-01-01T10:59:59.999999+00:00"),
    (5, 2, 11, "purchase", 5.0, "2024-01-01T11:00:00+00:00"),
    (6, None, 11, "view", 0.0, T0),
    (7, 3, None, "view", 0.0, T0),
    (8, 3, 12, "refund", 0.0, T0),
    (9, 3, 12, None, 0.0, T0),
    (10, 4, 12, "view", -1.0, T0),
    (11, 4, 12, "purchase", 0.0, T0),
    (12, 4, 12, "purchase", None, T0),
    (13, 4, 12, "purchase", float("nan"), T0),
    (14, 5, 12, "view", 0.0, "yesterday"),
]
BROKEN_VALUES = [(15, "not json"), (16, '"x"')]


def as_json(user, product, event_type, price, time) -> str:
    import json

    names = ("user_id", "product_id", "event_type", "price", "timestamp")
    return json.dumps(dict(zip(names, (user, product, event_type, price, time))))


def record(offset: int, value: str | None, key: str | None = None) -> tuple:
    from datetime import datetime, timedelta

    arrival = datetime(2024, 1, 2) + timedelta(seconds=offset)
    encoded = [None if x is None else bytearray(x.encode()) for x in (key, value)]
    return (*encoded, "ecommerce_events", 0, offset, arrival, 0)


@pytest.fixture(scope="session")
def edge_records(spark):
    from eventlake import schemas

    rows = [record(offset, as_json(*event)) for offset, *event in EDGE_EVENTS]
    rows += [record(offset, value) for offset, value in BROKEN_VALUES]
    return spark.createDataFrame(rows, schemas.RECORD)


@pytest.fixture(scope="session")
def edge_bronze(edge_records):
    from eventlake.functions.records import decode_records

    return decode_records(edge_records)


@pytest.fixture(scope="session")
def silver(spark):
    """Silver of the small test table, stored so tests do not recompute it."""
    from eventlake import adapters

    return adapters.silver(spark, "/root/testdata/sf0.001").cache()


@pytest.fixture(scope="session")
def make_silver(spark):
    """Silver rows from (user, product, type, price, time) tuples."""
    from pyspark.sql import functions as F

    def make(rows):
        schema = "user_id int, product_id int, event_type string, price double, at string"
        return spark.createDataFrame(rows, schema).select(
            "user_id",
            "product_id",
            "event_type",
            "price",
            F.to_timestamp("at").alias("event_timestamp"),
        )

    return make


def rows(df) -> list[tuple]:
    """Rows in a fixed order; NaN as text, so that it equals itself."""
    found = [tuple("NaN" if value != value else value for value in row) for row in df.collect()]
    return sorted(found, key=repr)
