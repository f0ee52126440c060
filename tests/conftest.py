import datetime as dt
import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from marketstrata.operators.tables import ensure_schema
from marketstrata.session import fresh_path, local_session

UTC = dt.timezone.utc


def shape(schema):
    """Names and types of a schema, without nullability."""
    return [(field.name, field.dataType.simpleString()) for field in schema.fields]


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def schema(spark):
    name = f"t_{uuid.uuid4().hex[:10]}"
    ensure_schema(spark, name, fresh_path(spark, "schema"))
    return name


@pytest.fixture
def coins(spark):
    """Payload rows: two good coins, the first one twice."""
    rows = [
        ("bitcoin", "btc", "Bitcoin", 40000.0, 760e9, 21e9, 2.5, "2024-02-01T12:00:00.000Z"),
        ("ethereum", "eth", "Ethereum", 2000.0, 240e9, 17e9, -1.5, "2024-02-01T12:00:00.000Z"),
        ("bitcoin", "btc", "Bitcoin", 39000.0, 741e9, 20e9, 0.5, "2024-02-01T11:00:00.000Z"),
    ]
    return spark.createDataFrame(
        rows,
        "id string, symbol string, name string, current_price double, market_cap double, total_volume double,"
        " price_change_percentage_24h double, last_updated string",
    )


@pytest.fixture
def silver_rows(spark):
    """One silver batch with ties, a NULL cap and no bitcoin."""
    caps = [900.0, 800.0, 800.0, 700.0, 600.0, 500.0, 400.0, 300.0, 200.0, 100.0, 100.0, 50.0, None]
    rows = [
        (f"k{i:02d}", f"s{i}", f"n{i}", 1.5 * i, cap, 10.0 * (i % 5), None if i == 3 else float(i - 6), "2023-05-01")
        for i, cap in enumerate(caps)
    ]
    return spark.createDataFrame(
        rows,
        "coin_id string, symbol string, name string, current_price_usd double, market_cap_usd double,"
        " total_volume_24h double, price_change_percentage_24h double, day string",
    ).selectExpr("* except(day)", "cast(day as timestamp) as silver_ingestion_time")
