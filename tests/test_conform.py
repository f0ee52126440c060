import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketstrata.contracts import BRONZE, SILVER
from marketstrata.operators.conform import (
    conform_bronze,
    fit_contract,
    missing_columns,
    require_columns,
    silver_transform,
    stamp_batch,
)
from tests.conftest import UTC, shape

NOW = dt.datetime(2023, 5, 1, 12, 30, tzinfo=UTC)


def test_required_columns_are_named(coins):
    with pytest.raises(ValueError, match="symbol, market_cap"):
        require_columns(coins.drop("symbol", "market_cap"))
    assert require_columns(coins) is coins


def test_bronze_contract_has_thirty_columns_in_order(coins):
    found = conform_bronze(stamp_batch(coins.withColumn("extra", F.lit(1)), NOW, "r1"))
    assert shape(found.schema) == shape(BRONZE)
    assert len(found.columns) == 30
    row = found.filter("id = 'ethereum'").first()
    assert (row["pipeline_run_id"], row["image"], row["market_cap"]) == ("r1", None, 240e9)


def test_conform_is_idempotent(coins):
    once = conform_bronze(stamp_batch(coins, NOW, "r1"))
    assert conform_bronze(once).exceptAll(once).count() == 0


def test_missing_columns_in_order(coins):
    assert missing_columns(coins, ["roi", "id", "ath"]) == ["roi", "ath"]


def test_stamp_only_if_absent(coins):
    kept = stamp_batch(coins.withColumn("pipeline_run_id", F.lit("mine")), NOW, "other")
    assert kept.select("pipeline_run_id").distinct().first()[0] == "mine"
    assert "ingestion_timestamp" in kept.columns
    assert stamp_batch(coins).first()["pipeline_run_id"].startswith("run_")


def test_fit_contract_turns_misfits_into_null(spark):
    rows = spark.createDataFrame([("a", "7"), ("b", "x")], "id string, market_cap_rank string")
    found = {r["id"]: r["market_cap_rank"] for r in fit_contract(rows, BRONZE).collect()}
    assert found == {"a": 7, "b": None}


def test_silver_transform(coins):
    dirty = coins.withColumn("ath_date", F.when(F.col("id") == "ethereum", "never").otherwise("2021-11-10T14:24:11.849Z"))
    found = silver_transform(conform_bronze(stamp_batch(dirty, NOW, "r1")), NOW)
    assert shape(found.schema) == shape(SILVER)
    assert len(found.columns) == 28
    rows = {(r["coin_id"], r["current_price_usd"]): r for r in found.collect()}
    eth = rows[("ethereum", 2000.0)]
    assert eth["ath_date"] is None
    assert eth["market_dominance"] == pytest.approx(240e9 / 1741e9 * 100)
    assert found.agg(F.sum("market_dominance")).first()[0] == pytest.approx(100.0)


def test_total_of_zero_or_null_gives_null_share(spark):
    columns = "id string, symbol string, name string, current_price double, market_cap double"
    for cap in (0.0, None):
        rows = spark.createDataFrame([("a", "a", "a", 1.0, cap), ("b", "b", "b", 1.0, cap)], columns)
        found = silver_transform(conform_bronze(stamp_batch(rows, NOW, "r")), NOW)
        assert {r["market_dominance"] for r in found.collect()} == {None}
